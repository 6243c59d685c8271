import os

import pytest

from sensorwatch.streaming import sinks

SCHEMA = "k string, v long"


def _batch(spark, path, n, rows, done=True):
    out = f"{path}/batch_id={n}"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(out)
    if not done:
        os.remove(f"{out}/_SUCCESS")


def test_unfinished_batches_wait_and_snapshots_stay(spark, tmp_path):
    log, snaps = str(tmp_path / "log"), str(tmp_path / "snaps")
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(ValueError):
        sinks.compact_changelog(spark, log, schema, ["k"], snaps)
    _batch(spark, log, 0, [("a", 1), ("b", 1)])
    _batch(spark, log, 1, [("a", 2), ("c", 2)], done=False)
    _batch(spark, log, 2, [("b", 3)])
    one = sinks.compact_changelog(spark, log, schema, ["k"], snaps)
    assert "upto=0-" in one
    assert sinks.compact_changelog(spark, log, schema, ["k"], snaps, one) == one
    open(f"{log}/batch_id=1/_SUCCESS", "w").close()
    two = sinks.compact_changelog(spark, log, schema, ["k"], snaps, one)
    assert "upto=2-" in two and os.path.isdir(one)
    rows = sinks.current_rows(spark, log, schema, ["k"], two).collect()
    assert sorted((r.k, r.v) for r in rows) == [("a", 2), ("b", 3), ("c", 2)]


def test_newest_rows_are_hashed(spark, tmp_path):
    log = str(tmp_path / "log")
    _batch(spark, log, 0, [("a", 1)])
    _batch(spark, log, 1, [("a", None)])
    latest = sinks.latest_rows(sinks.read_changelog(spark, log, spark.createDataFrame([], SCHEMA).schema), ["k"])
    plan = latest._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert [tuple(r) for r in latest.collect()] == [("a", None)]
