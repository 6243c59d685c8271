"""Properties of rule matching and windowing, plus a skewed input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorwatch.config import AlertSettings
from sensorwatch.operators.rule_join import match_rules
from sensorwatch.operators.windows import window_averages
from sensorwatch.sources.rules import RULE_SCHEMA

U = -999
AVG_SCHEMA = "window struct<start: timestamp, end: timestamp>, avg_temperature double, avg_humidity double, n int"

bound = st.one_of(st.just(U), st.integers(-50, 150))
rule = st.tuples(bound, bound, bound, bound)
avg = st.one_of(st.none(), st.floats(-60, 160, allow_nan=False))


def _fired(spark, avgs, rules, bins=4):
    adf = spark.createDataFrame([((None, None), t, h, i) for i, (t, h) in enumerate(avgs)], AVG_SCHEMA)
    rdf = spark.createDataFrame([(i, *[None if b is None else float(b) for b in r], 100 + i, f"r{i}") for i, r in enumerate(rules)], RULE_SCHEMA)
    return {(r.id, r.n) for r in match_rules(adf, rdf, AlertSettings(rule_bins=bins)).collect()}


def _widen(r, k):
    hmin, hmax, tmin, tmax = r
    lower = lambda b: b if b == U else b - k
    upper = lambda b: b if b == U else b + k
    return (lower(hmin), upper(hmax), lower(tmin), upper(tmax))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    avgs=st.lists(st.tuples(avg, avg), min_size=1, max_size=12),
    rules=st.lists(rule, min_size=1, max_size=6),
    k=st.integers(1, 30),
    bins=st.sampled_from([1, 4, 32]),
)
def test_widening_bounds_never_removes_an_alert(spark, avgs, rules, k, bins):
    before = _fired(spark, avgs, rules, bins)
    after = _fired(spark, avgs, [_widen(r, k) for r in rules], bins)
    assert before <= after


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(avgs=st.lists(st.tuples(avg, avg), min_size=1, max_size=12), rules=st.lists(rule, min_size=1, max_size=6))
def test_every_alert_satisfies_its_rule_and_cuts_agree(spark, avgs, rules):
    fired = _fired(spark, avgs, rules)
    assert fired == _fired(spark, avgs, rules, 32)

    def ok(v, lo, hi):
        return (lo == U or (v is not None and v >= lo)) and (hi == U or (v is not None and v <= hi))

    want = {
        (i, n)
        for i, (hmin, hmax, tmin, tmax) in enumerate(rules)
        for n, (t, h) in enumerate(avgs)
        if ok(h, hmin, hmax) and ok(t, tmin, tmax)
    }
    assert fired == want


def test_hot_instant_with_a_third_of_all_readings(spark):
    """One second holds a third of the readings; the pane plan still equals the per-reading window plan."""
    n = 30_000
    base = dt.datetime(2024, 1, 1)
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(base))
        .otherwise(F.timestamp_seconds(F.lit(int(base.replace(tzinfo=dt.timezone.utc).timestamp())) + F.col("id")))
        .alias("timestamp"),
        (F.col("id") % 10).cast("int").alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("temperature")).otherwise(F.lit("humidity")).alias("sensor"),
        (F.col("id") % 50).cast("int").alias("value"),
    )
    s = AlertSettings()
    got = window_averages(df, s, by_sensor=True)
    want = df.groupBy(F.window("timestamp", s.window, s.slide).alias("window"), F.col("id").alias("sensor_id")).agg(
        F.avg(F.when(F.col("sensor") == "temperature", F.col("value"))).alias("avg_temperature"),
        F.avg(F.when(F.col("sensor") == "humidity", F.col("value"))).alias("avg_humidity"),
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
