"""State reader, progress log, transitions, per-batch alerts with hot nodes, publish ledger, snapshots beside the changelog."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sensorwatch.config import DEFAULT, AlertSettings
from sensorwatch.functions.messages import alert_messages
from sensorwatch.operators import rule_join
from sensorwatch.operators.rule_join import match_rules
from sensorwatch.operators.windows import flatten_window, window_averages
from sensorwatch.session import run_dir
from sensorwatch.sources.rules import RULE_SCHEMA, read_rules
from sensorwatch.streaming import alerts, jobs, monitor, sinks

from .test_streaming_golden import FILES, _hm, _write_inputs

READING = "timestamp timestamp, id int, sensor string, value int"


def _golden(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_inputs(src, list(FILES.items()))
    return jobs.json_file_readings(spark, src, 1)


def test_transitions_take_back_an_alert(spark, tmp_path):
    base = run_dir(spark, "t_transitions")
    changes = alerts.transitions(_golden(spark, tmp_path), read_rules(spark), DEFAULT)
    alerts.start_transitions(changes, f"{base}/log", f"{base}/ckpt", 4).awaitTermination()
    log = flatten_window(sinks.read_changelog(spark, f"{base}/log", changes.schema))
    got = sorted((r.batch_id, _hm(r.window_start), r.code, r.change) for r in log.collect())
    assert got == sorted(
        [(0, w, c, "raised") for w in ("13:04:30", "13:05:00", "13:05:30") for c in (101, 104)]
        + [(1, w, c, "raised") for w in ("13:06:00", "13:06:30") for c in (102, 103)]
        # a late reading of 0 degrees: 104 no longer fires, 103 does, 101 stays and is not told again
        + [(2, "13:05:00", 103, "raised"), (2, "13:05:00", 104, "cleared")]
    )


def test_transitions_refuse_a_table_without_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alerts, "MOST_RULES", 3)
    with pytest.raises(ValueError, match="at most 3 rules"):
        alerts.transitions(_golden(spark, tmp_path), read_rules(spark), DEFAULT)


def test_state_rows_and_progress_table(spark, tmp_path):
    base = run_dir(spark, "t_state")
    averages = jobs.averages_stream(_golden(spark, tmp_path), DEFAULT)
    with monitor.ProgressLog(spark, f"{base}/progress") as log:
        query = sinks.start_changelog(averages, f"{base}/log", f"{base}/ckpt", state_partitions=2)
        query.awaitTermination()
        log.wait_for(query)
    state = flatten_window(monitor.state_rows(spark, f"{base}/ckpt")).collect()
    assert sorted((_hm(r.window_start), r.sum_temperature, r.count_temperature, r.sum_humidity, r.count_humidity) for r in state) == [
        ("13:11:00", None, 0, 50, 1), ("13:11:30", None, 0, 50, 1),
    ]
    rows = log.table().where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r.input_rows, r.dropped_rows) for r in rows] == [(4, 0), (2, 0), (2, 1), (1, 0)]
    assert _hm(rows[3].watermark) == "13:08:10"


def test_no_progress_event_is_lost(spark, tmp_path):
    log = monitor.ProgressLog(spark, str(tmp_path / "progress"), watch={"mine"}, every=60)
    for n in range(250):
        for name in ("mine", "other"):
            op = SimpleNamespace(numRowsDroppedByWatermark=n, numRowsTotal=5)
            p = SimpleNamespace(
                name=name, id="x", runId="r", batchId=n, eventTime={"watermark": "2024-01-01T00:00:00.000Z"} if n else {},
                numInputRows=1, stateOperators=[op, op], batchDuration=3,
            )
            log.onQueryProgress(SimpleNamespace(progress=p))
    log.flush()
    got = log.table().agg(F.count("*"), F.countDistinct("batch_id"), F.sum("dropped_rows"), F.count("watermark")).first()
    assert tuple(got) == (250, 250, 2 * sum(range(250)), 249)


def _skewed(spark, path, n, day):
    """A window a minute; a third of all averages equal."""
    rows = spark.range(n).selectExpr(
        f"timestamp_seconds(1704067200 + {day} * 8640000 + id * 60) AS timestamp", "1 AS id", "'humidity' AS sensor",
        "CAST(IF(id % 3 = 0, 50, 15 + id * 7 % 71) AS INT) AS value",
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def test_hot_node_is_dealt_out_in_a_stream(spark, tmp_path, monkeypatch):
    src, base = str(tmp_path / "in"), run_dir(spark, "t_hot")
    settings = AlertSettings(window="1 minute", slide="1 minute")
    rules = spark.createDataFrame(
        [(i, 15.0 + i % 60, 15.5 + i % 60, -999.0, -999.0, 100, f"r{i}") for i in range(600)] + [(700, 49.0, 51.0, -999.0, -999.0, 101, "hot")],
        RULE_SCHEMA,
    )
    dealt = []
    salted = rule_join._salted

    def spy(listed, hot, for_rules):
        out = salted(listed, hot, for_rules)
        if not for_rules:
            keys = [c for c in out.columns if c.startswith("_rj_")]
            sizes = sorted(r["count"] for r in out.groupBy(F.pmod(F.hash(*keys), F.lit(16))).count().collect())
            if sizes:
                dealt.append((len(hot), sizes[-1] / sizes[len(sizes) // 2]))
        return out

    monkeypatch.setattr(rule_join, "_salted", spy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a rules table over the threshold
    try:
        for day in range(2):  # two runs: the second one knows the first one's batch
            _skewed(spark, src, 6_000, day)
            averages = jobs.averages_stream(spark.readStream.schema(READING).parquet(src), settings)
            alerts.start_alerts(averages, rules, base, f"{base}/ckpt", settings, state_partitions=4).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.undo()
    assert len(dealt) == 2  # batches with rows
    assert dealt[0][0] == 0 and dealt[0][1] > 5  # nothing is known of the first batch
    assert dealt[1][0] > 0 and dealt[1][1] < 5
    averages = window_averages(spark.read.schema(READING).parquet(src), settings)
    want = match_rules(averages, rules, settings)
    got = sinks.read_changelog(spark, f"{base}/alerts", want.schema).drop("batch_id")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_publish_once_over_crash_and_lost_checkpoint(spark, tmp_path):
    src, base = str(tmp_path / "in"), run_dir(spark, "t_publish")
    _write_inputs(src, list(FILES.items()))
    settings = AlertSettings(message_time_zone="UTC")
    failed = []

    def crash(batch_id):
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost between output and ledger")

    def run(checkpoint):
        found = jobs.alerts_stream(jobs.json_file_readings(spark, src, 1), read_rules(spark), settings)
        query = alerts.start_publish_once(
            found, lambda rows: alert_messages(rows, settings, sent_at="now"), f"{base}/out", f"{base}/{checkpoint}", settings, crash
        )
        query.awaitTermination()

    with pytest.raises(Exception, match="lost between"):
        run("one")
    run("one")  # replays the failed batch
    table = spark.read.schema("topic string, value string").parquet(f"{base}/out/messages")
    first = sorted(map(tuple, table.select("topic", "value").collect()))
    assert len(first) == len(set(first)) == 10
    run("two")  # a new checkpoint: all input again
    table = spark.read.schema("topic string, value string").parquet(f"{base}/out/messages")
    assert sorted(map(tuple, table.select("topic", "value").collect())) == first


def test_snapshots_beside_the_changelog(spark, tmp_path):
    base = run_dir(spark, "t_snap")
    averages = jobs.averages_stream(_golden(spark, tmp_path), DEFAULT)
    sinks.start_changelog(averages, f"{base}/log", f"{base}/ckpt", compact_keys=["window"], compact_every=2).awaitTermination()
    names = sorted(n.split("-")[0] for n in os.listdir(f"{base}/log-snapshots"))
    assert names == ["upto=0", "upto=2", "upto=4"]
    newest = sinks.latest_rows(sinks.read_changelog(spark, f"{base}/log", averages.schema), ["window"])
    got = sinks.read_current(spark, f"{base}/log", averages.schema, ["window"])
    assert got.count() == newest.count() == 9 and got.exceptAll(newest).count() == 0


def test_sums_are_exact(spark, tmp_path):
    # one odd unit beside values near 2^53: a sum of doubles loses it
    big, kind = 2**53, "timestamp timestamp, id int, sensor string, value bigint"
    rows = [(0, 1, "temperature", v) for v in [big, 1, 1, 1, -big, 2]]
    df = spark.createDataFrame(rows, "t long, id int, sensor string, value bigint").selectExpr("timestamp_seconds(t) AS timestamp", "id", "sensor", "value")
    assert {r.avg_temperature for r in window_averages(df).collect()} == {5 / 6}
    path, base = str(tmp_path / "in"), run_dir(spark, "t_exact")
    df.coalesce(1).write.parquet(path)
    averages = jobs.averages_stream(spark.readStream.schema(kind).parquet(path), DEFAULT)
    sinks.start_changelog(averages, f"{base}/log", f"{base}/ckpt", state_partitions=2).awaitTermination()
    out = sinks.read_changelog(spark, f"{base}/log", averages.schema).collect()
    assert {r.avg_temperature for r in out} == {5 / 6}
    ints = df.selectExpr("timestamp", "id", "sensor", "CAST(2147483647 AS INT) AS value")
    assert {r.avg_temperature for r in window_averages(ints).collect()} == {2147483647.0}


def test_windows_from_state_are_not_broadcast(spark, tmp_path):
    base = run_dir(spark, "t_closing")
    found = jobs.alerts_stream(_golden(spark, tmp_path), read_rules(spark), DEFAULT, by_sensor=True)
    query = sinks.start_table(found, f"{base}/table", f"{base}/ckpt", state_partitions=2)
    query.awaitTermination()
    # the last batch has no input: its windows all come from the state, and statistics put them at no bytes
    assert query.lastProgress.numInputRows == 0
    plan = query._jsq.explainInternal(False)
    build = plan.split("BroadcastExchange")[1]
    assert "humidity_min" in build and "StateStoreRestore" not in build
    assert spark.read.schema(found.schema).parquet(f"{base}/table").count() > 0


def test_transitions_of_many_sensors_share_state_rows(spark, tmp_path):
    src, base = str(tmp_path / "in"), run_dir(spark, "t_sensors")
    settings, found = AlertSettings(window="1 minute", slide="1 minute"), []
    for value in (50, 10, 60):  # a run each: too wet or not, by the mean so far: 50, 30, 40
        rows = spark.range(5_000).selectExpr(
            "timestamp_seconds(1704067200) AS timestamp", "CAST(IF(id = 7, NULL, id) AS INT) AS id", "'humidity' AS sensor",
            f"CAST(IF(id % 2 = 0, 70, {value}) AS INT) AS value",
        )
        rows.coalesce(1).write.mode("append").parquet(src)
        changes = alerts.transitions(spark.readStream.schema(READING).parquet(src), read_rules(spark), settings, by_sensor=True)
        query = alerts.start_transitions(changes, f"{base}/log", f"{base}/ckpt", 2)
        query.awaitTermination()
        found.append(max(op.numRowsTotal for p in query.recentProgress for op in p.stateOperators))
    assert max(found) <= 2 * alerts.SENSOR_GROUPS  # a row and a timer each, not one per sensor
    log = sinks.read_changelog(spark, f"{base}/log", changes.schema).orderBy("batch_id", "sensor_id").collect()
    wet = [(r.sensor_id, r.change, r.avg_humidity) for r in log if r.code == 102]
    dry = [(r.sensor_id, r.change, r.avg_humidity) for r in log if r.code == 101]
    assert wet == [(i, "raised", 70.0) for i in range(0, 5_000, 2)]  # told once, not again with every run
    odd = [None, *[i for i in range(1, 5_000, 2) if i != 7]]
    assert dry == [(i, "raised", 30.0) for i in odd]  # 40 is still too dry
    assert {r.code for r in log} == {101, 102} and {r.avg_temperature for r in log} == {None}
