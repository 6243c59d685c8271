"""Golden micro-batch run (FIXTURES.md section 3): four files, one per batch."""

import json
import os
import time

import pytest

from sensorwatch.config import DEFAULT
from sensorwatch.operators.windows import flatten_window
from sensorwatch.session import run_dir
from sensorwatch.sources.rules import read_rules
from sensorwatch.streaming import jobs, sinks

BASE = 1724072700.25  # 2024-08-19 13:05:00.25 UTC
FILES = {
    "a": [(0, "temperature", 44), (29, "humidity", 20), (30, "temperature", 40), (59, "humidity", 30)],
    "b": [(100, "temperature", 25), (100, "humidity", 70)],
    "c": [(5, "temperature", 0), (200, "temperature", 36)],
    "d": [(400, "humidity", 50)],
}


def _write_inputs(path, groups):
    os.makedirs(path)
    now = time.time() - 100
    for i, (name, rows) in enumerate(groups):
        f = os.path.join(path, f"{name}.json")
        with open(f, "w") as fh:
            for off, sensor, value in rows:
                fh.write(json.dumps({"timestamp": BASE + off, "id": 1, "sensor": sensor, "value": value}) + "\n")
        os.utime(f, (now + i, now + i))


def _hm(t):
    return t.strftime("%H:%M:%S")


def _run(spark, df, mode, name):
    base = run_dir(spark, name)
    q = sinks.start_changelog(df, f"{base}/log", f"{base}/ckpt", output_mode=mode)
    q.awaitTermination()
    log = sinks.read_changelog(spark, f"{base}/log", df.schema)
    return flatten_window(log), q


def _readings(spark, tmp_path, groups):
    src = str(tmp_path / "in")
    _write_inputs(src, groups)
    return jobs.json_file_readings(spark, src, 1)


@pytest.fixture()
def per_file(tmp_path):
    return [(k, v) for k, v in FILES.items()]


def test_update_mode_averages(spark, tmp_path, per_file):
    readings = _readings(spark, tmp_path, per_file)
    out, q = _run(spark, jobs.averages_stream(readings, DEFAULT), "update", "golden_avg_update")
    got = sorted((r.batch_id, _hm(r.window_start), r.avg_temperature, r.avg_humidity) for r in out.collect())
    assert got == [
        (0, "13:04:30", 44.0, 20.0),
        (0, "13:05:00", 42.0, 25.0),
        (0, "13:05:30", 40.0, 30.0),
        (1, "13:06:00", 25.0, 70.0),
        (1, "13:06:30", 25.0, 70.0),
        (2, "13:05:00", 28.0, 25.0),
        (2, "13:07:30", 36.0, None),
        (2, "13:08:00", 36.0, None),
        (3, "13:11:00", None, 50.0),
        (3, "13:11:30", None, 50.0),
    ]
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    wms = [p["eventTime"].get("watermark") for p in q.recentProgress]
    assert wms[:5] == [
        "1970-01-01T00:00:00.000Z",
        "2024-08-19T13:05:49.000Z",
        "2024-08-19T13:06:30.000Z",
        "2024-08-19T13:08:10.000Z",
        "2024-08-19T13:11:30.000Z",
    ]


def test_append_mode_averages(spark, tmp_path, per_file):
    readings = _readings(spark, tmp_path, per_file)
    out, _ = _run(spark, jobs.averages_stream(readings, DEFAULT), "append", "golden_avg_append")
    got = sorted((r.batch_id, _hm(r.window_start), r.avg_temperature, r.avg_humidity) for r in out.collect())
    assert got == [
        (1, "13:04:30", 44.0, 20.0),
        (2, "13:05:00", 28.0, 25.0),
        (2, "13:05:30", 40.0, 30.0),
        (3, "13:06:00", 25.0, 70.0),
        (3, "13:06:30", 25.0, 70.0),
        (4, "13:07:30", 36.0, None),
        (4, "13:08:00", 36.0, None),
    ]


def _codes(out):
    got = {}
    for r in out.collect():
        got.setdefault((r.batch_id, _hm(r.window_start)), []).append(r.code)
    return {k: sorted(v) for k, v in got.items()}


def test_update_mode_alerts_are_not_retracted(spark, tmp_path, per_file):
    readings = _readings(spark, tmp_path, per_file)
    out, _ = _run(spark, jobs.alerts_stream(readings, read_rules(spark), DEFAULT), "update", "golden_alerts_update")
    assert _codes(out) == {
        (0, "13:04:30"): [101, 104],
        (0, "13:05:00"): [101, 104],
        (0, "13:05:30"): [101, 104],
        (1, "13:06:00"): [102, 103],
        (1, "13:06:30"): [102, 103],
        (2, "13:05:00"): [101, 103],
    }


def test_append_mode_alerts(spark, tmp_path, per_file):
    readings = _readings(spark, tmp_path, per_file)
    out, _ = _run(spark, jobs.alerts_stream(readings, read_rules(spark), DEFAULT), "append", "golden_alerts_append")
    assert _codes(out) == {
        (1, "13:04:30"): [101, 104],
        (2, "13:05:00"): [101, 103],
        (2, "13:05:30"): [101, 104],
        (3, "13:06:00"): [102, 103],
        (3, "13:06:30"): [102, 103],
    }


def test_current_alerts_from_upserted_averages(spark, tmp_path, per_file):
    """Update mode done right: newest averages per window, alerts derived from them."""
    from sensorwatch.operators.rule_join import match_rules

    readings = _readings(spark, tmp_path, per_file)
    averages = jobs.averages_stream(readings, DEFAULT)
    base = run_dir(spark, "golden_current")
    sinks.start_changelog(averages, f"{base}/log", f"{base}/ckpt").awaitTermination()
    current = sinks.latest_rows(sinks.read_changelog(spark, f"{base}/log", averages.schema), ["window"])
    alerts = flatten_window(match_rules(current, read_rules(spark)))
    got = sorted((_hm(r.window_start), r.code) for r in alerts.collect())
    # 13:05:00 no longer fires 104 once the late reading is in
    assert ("13:05:00", 104) not in got and ("13:05:00", 103) in got


def test_one_batch_nothing_is_late(spark, tmp_path):
    rows = [r for v in FILES.values() for r in v]
    readings = _readings(spark, tmp_path, [("all", rows)])
    out, _ = _run(spark, jobs.averages_stream(readings, DEFAULT), "update", "golden_one_batch")
    first = [r for r in out.collect() if _hm(r.window_start) == "13:04:30"]
    assert [(r.avg_temperature, r.avg_humidity) for r in first] == [(22.0, 20.0)]


def test_compacted_changelog_equals_full_history(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_inputs(src, list(FILES.items())[:2])
    readings = jobs.json_file_readings(spark, src, 1)
    averages = jobs.averages_stream(readings, DEFAULT)
    base = run_dir(spark, "golden_compact")
    sinks.start_changelog(averages, f"{base}/log", f"{base}/ckpt").awaitTermination()
    snap = sinks.compact_changelog(spark, f"{base}/log", averages.schema, ["window"], f"{base}/snapshots")
    # more data arrives after the snapshot
    now = time.time()
    with open(os.path.join(src, "c.json"), "w") as fh:
        for off, sensor, value in FILES["c"]:
            fh.write(json.dumps({"timestamp": BASE + off, "id": 1, "sensor": sensor, "value": value}) + "\n")
    os.utime(os.path.join(src, "c.json"), (now, now))
    readings = jobs.json_file_readings(spark, src, 1)
    averages = jobs.averages_stream(readings, DEFAULT)
    sinks.start_changelog(averages, f"{base}/log", f"{base}/ckpt").awaitTermination()
    log = sinks.read_changelog(spark, f"{base}/log", averages.schema)
    want = sinks.latest_rows(log, ["window"])
    got = sinks.current_rows(spark, f"{base}/log", averages.schema, ["window"], snap).drop("batch_id")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    # the first run ended with an eviction batch that moved the watermark to 13:06:30, so the
    # 13:05:05 reading of file c is late for both its windows here (unlike the one-file-per-batch run)
    assert sorted(r.avg_temperature for r in got.where("window.start = TIMESTAMP'2024-08-19 13:05:00'").collect()) == [42.0]
