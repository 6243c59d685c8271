"""Streams give the same windows and alerts however the events table is laid out."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sensorwatch.plans.oracle import ORACLE
from sensorwatch.plans.queries import QUERIES

from .conftest import SF_SMALL

STREAMS = ["stream_window_avg_update", "stream_alerts_update", "stream_alerts_append", "stream_alerts_by_sensor"]


def _same(spark, name, folder, files):
    got = QUERIES[name](spark, folder).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{files}'")
    want = con.sql(ORACLE[name]).df()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    rows = lambda d: sorted(map(str, d[cols].astype(str).values.tolist()))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_shuffled_parts(spark, tmp_path, parts):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(parts, F.xxhash64("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    events.limit(3).write.parquet(str(tmp_path / "events_old.parquet"))  # a neighbour that is not read
    for name in STREAMS if parts == 4 else STREAMS[:1]:
        _same(spark, name, str(tmp_path), tmp_path / "events.parquet/*.parquet")


def test_late_data_with_null_values(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    value = F.when(F.col("event_id") % 10 != 0, F.col("value"))
    events.withColumn("value", value).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    _same(spark, "stream_late_data", str(tmp_path), tmp_path / "events.parquet/*.parquet")
