import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorwatch.functions.timecols import (
    duration_micros,
    epoch_text_to_time,
    instant_to_utc_wall,
    iso_text,
    pane_micros,
    utc_wall_to_instant,
)


@pytest.mark.parametrize(
    "text,micros",
    [
        ("1 minute", 60_000_000),
        ("30 seconds", 30_000_000),
        ("10 seconds", 10_000_000),
        ("1 hour", 3_600_000_000),
        ("1 hour 30 minutes", 5_400_000_000),
        ("interval 2 days", 172_800_000_000),
        ("250 milliseconds", 250_000),
    ],
)
def test_duration_micros(text, micros):
    assert duration_micros(text) == micros


@pytest.mark.parametrize("bad", ["", "1 month", "minute", "0 seconds", "1 minute and more"])
def test_duration_refused(bad):
    with pytest.raises(ValueError):
        duration_micros(bad)


def test_pane_is_gcd():
    assert pane_micros("1 minute", "30 seconds") == 30_000_000
    assert pane_micros("50 seconds", "20 seconds") == 10_000_000
    assert pane_micros("1 hour", "1 hour") == 3_600_000_000
    with pytest.raises(ValueError):
        pane_micros("10 seconds", "1 minute")


def test_epoch_text_to_time(spark):
    rows = [("1724072749.987654",), ("1.724072749987654E9",), ("-1.5",), ("abc",), (None,), ("NaN",), ("1e30",), ("9e15",)]
    df = spark.createDataFrame(rows, "t string").select(epoch_text_to_time("t").alias("ts"))
    got = [r.ts for r in df.collect()]
    utc = dt.timezone.utc
    assert got[0].astimezone(utc).replace(tzinfo=None) == dt.datetime(2024, 8, 19, 13, 5, 49)
    assert got[1] == got[0]
    # cut toward zero: -1.5 s -> -1 s
    assert got[2].astimezone(utc).replace(tzinfo=None) == dt.datetime(1969, 12, 31, 23, 59, 59)
    assert got[3:] == [None] * 5


def test_utc_wall_round_trip_in_other_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-10 02:30:00.000001'), (TIMESTAMP_NTZ'2024-11-03 06:30:00'),"
            " (TIMESTAMP_NTZ'2024-07-01 12:00:00.5') AS t(ts)"
        )
        out = df.select(
            "ts",
            F.unix_micros(utc_wall_to_instant("ts")).alias("us"),
            instant_to_utc_wall(utc_wall_to_instant("ts")).alias("back"),
        ).collect()
        for r in out:
            assert r.back == r.ts
            assert r.us == int((r.ts - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_text(spark):
    df = spark.sql(
        "SELECT TIMESTAMP'2025-06-11 07:41:30' AS a, TIMESTAMP'2025-06-11 07:42:19.030405' AS b, TIMESTAMP'2025-06-11 07:42:19.5' AS c"
    )
    r = df.select(iso_text(F.col("a")).alias("a"), iso_text(F.col("b")).alias("b"), iso_text(F.col("c"), "Europe/Kyiv").alias("c")).first()
    assert r.a == "2025-06-11T07:41:30"
    assert r.b == "2025-06-11T07:42:19.030405"
    assert r.c == "2025-06-11T10:42:19.500000"
