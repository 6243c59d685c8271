import pytest
from pyspark.sql import functions as F

from sensorwatch.config import AlertSettings
from sensorwatch.operators.windows import window_averages
from sensorwatch.sources.events import read_events, readings_from_events

from .conftest import SF_SMALL


def _plain(readings, s, by_sensor=False):
    keys = [F.col("id").alias("sensor_id")] if by_sensor else []
    return readings.groupBy(F.window("timestamp", s.window, s.slide).alias("window"), *keys).agg(
        *[F.avg(F.when(F.col("sensor") == m, F.col("value"))).alias(f"avg_{m}") for m in s.measures]
    )


@pytest.mark.parametrize(
    "window,slide,by_sensor",
    [
        ("1 minute", "30 seconds", False),
        ("1 hour", "30 minutes", False),
        ("50 seconds", "20 seconds", False),
        ("10 minutes", "10 minutes", False),
        ("1 minute", "30 seconds", True),
    ],
)
def test_pane_plan_equals_plain_window_group(spark, window, slide, by_sensor):
    readings = readings_from_events(read_events(spark, SF_SMALL))
    s = AlertSettings(window=window, slide=slide)
    a = window_averages(readings, s, by_sensor=by_sensor)
    b = _plain(readings, s, by_sensor)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_each_reading_in_window_over_slide_windows(spark):
    readings = readings_from_events(read_events(spark, SF_SMALL)).where(F.col("sensor") == "temperature")
    s = AlertSettings(window="1 minute", slide="20 seconds")
    counts = readings.groupBy(F.window("timestamp", s.window, s.slide)).count()
    assert counts.agg(F.sum("count")).first()[0] == 3 * readings.count()


def test_window_with_only_other_sensors_has_null_averages(spark):
    df = spark.sql(
        "SELECT TIMESTAMP'2024-01-01 00:00:10' AS timestamp, 1 AS id, 'other' AS sensor, 5 AS value "
        "UNION ALL SELECT CAST(NULL AS TIMESTAMP), 1, 'temperature', 30"
    )
    rows = window_averages(df).collect()
    assert len(rows) == 2
    assert all(r.avg_temperature is None and r.avg_humidity is None for r in rows)


def test_sensor_match_is_case_sensitive(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:10' AS timestamp, 1 AS id, 'Temperature' AS sensor, 5 AS value")
    assert all(r.avg_temperature is None for r in window_averages(df).collect())
