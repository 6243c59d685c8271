"""Physical plan shape: pruning, pushdown, no per-row re-evaluation, join strategies."""

import contextlib
import io

from sensorwatch.operators.rule_join import match_rules
from sensorwatch.operators.windows import window_averages
from sensorwatch.plans.queries import QUERIES
from sensorwatch.sources.events import read_events, readings_from_events
from sensorwatch.sources.rules import read_rules

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _ops(text: str) -> list[str]:
    """Operator names of the formatted plan tree, root first."""
    tree = text.split("== Physical Plan ==")[1].split("\n\n")[0]
    return [ln.strip(" +-:").split(" (")[0] for ln in tree.splitlines() if ln.strip(" +-:")]


def test_window_avg_reads_three_columns_and_filters_only_aggregated_rows(spark):
    text = _formatted(QUERIES["window_avg"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    ops = _ops(text)
    aggs = [i for i, o in enumerate(ops) if o == "HashAggregate"]
    assert len(aggs) == 4  # partial + final, twice
    # the time expression is evaluated once per reading: any Filter runs on aggregated rows only
    assert all(i < min(aggs) for i, o in enumerate(ops) if o == "Filter")


def test_window_avg_expands_panes_not_readings(spark):
    ops = _ops(_formatted(QUERIES["window_avg"](spark, SF_SMALL)))
    bottom_agg = max(i for i, o in enumerate(ops) if o == "HashAggregate")
    assert ops.index("Generate") < bottom_agg and "Expand" not in ops


def test_alerts_broadcast_rules_side(spark):
    text = _plan(QUERIES["alerts"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text and "BuildRight" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    build = text.split("BroadcastExchange")[1]
    assert "humidity_min" in build and "_pane" not in build  # the rules are broadcast, the windows stream


def test_rule_join_is_an_equi_join(spark):
    readings = readings_from_events(read_events(spark, SF_SMALL))
    df = match_rules(window_averages(readings), read_rules(spark))
    text = _plan(df)
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert any(j in text for j in ("SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin"))
    assert "_rj_0" in text and "_rj_1" in text


def test_decode_parses_json_once(spark):
    text = _formatted(QUERIES["decode_readings"](spark, SF_SMALL))
    tree_and_details = text.split("== Physical Plan ==")[1]
    assert tree_and_details.count("from_json(") == 1


def test_latest_rows_hash(spark):
    text = _plan(QUERIES["stream_window_avg_update"](spark, SF_SMALL))
    assert "HashAggregate" in text and "SortAggregate" not in text
