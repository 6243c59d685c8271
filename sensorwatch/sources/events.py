"""Readings derived from the ``events`` table.

A reading is one measurement of one sensor: ``timestamp, id, sensor, value``.
The test tables carry no sensor data, so readings are derived from ``events``
by a fixed rule (FIXTURES.md section 2); event types outside the two sensor
groups become sensor ``other`` so that windows without any temperature or
humidity reading also occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import HUMIDITY_RANGE, SENSOR_HUMIDITY, SENSOR_TEMPERATURE, TEMPERATURE_RANGE
from ..functions.timecols import utc_wall_to_instant_sql

# Event types read as each sensor (others become "other").
TEMPERATURE_EVENT_TYPES = ("click", "view")
HUMIDITY_EVENT_TYPES = ("purchase", "signup")
OTHER_SENSOR = "other"

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def read_events_stream(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None, glob: str = "events.parque[t]"
) -> DataFrame:
    """``events`` as a file stream: new parquet files under ``<sf_dir>/<glob>`` are new input.

    The glob (a pattern, so that a single file is taken too) matches single files (``events.parquet``) as well as directories of
    part files written by Spark (``events.parquet/part-*.parquet``); it is
    listed again at every trigger. ``max_files_per_trigger=None`` takes every
    new file into the next micro-batch.
    """
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{glob}")


def _sql_list(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


def event_sensor_sql(event_type: str = "event_type") -> str:
    """SQL: the sensor an event type is read as."""
    c = f"`{event_type}`"
    return (
        f"CASE WHEN {c} IN ({_sql_list(TEMPERATURE_EVENT_TYPES)}) THEN '{SENSOR_TEMPERATURE}'"
        f" WHEN {c} IN ({_sql_list(HUMIDITY_EVENT_TYPES)}) THEN '{SENSOR_HUMIDITY}'"
        f" ELSE '{OTHER_SENSOR}' END"
    )


def readings_from_events(events: DataFrame, keep_fraction: bool = False) -> DataFrame:
    """``events`` -> readings ``timestamp TIMESTAMP, id INT, sensor STRING, value INT``.

    ``ts`` is UTC wall-clock time. With ``keep_fraction`` the sub-second part is
    kept (as a producer stamping ``time.time()`` would send it); otherwise the
    time is cut to whole seconds, as decoding does. Values are folded into each
    sensor's range: ``lo + floor(value) % (hi - lo + 1)``.
    """
    (tlo, thi), (hlo, hhi) = TEMPERATURE_RANGE, HUMIDITY_RANGE
    step = events.selectExpr(
        f"{utc_wall_to_instant_sql('ts', 1 if keep_fraction else 1_000_000)} AS timestamp",
        "try_cast(user_id AS INT) AS id",
        f"{event_sensor_sql()} AS sensor",
        "floor(value) AS _v",
    )
    return step.selectExpr(
        "timestamp",
        "id",
        "sensor",
        f"try_cast(CASE sensor WHEN '{SENSOR_TEMPERATURE}' THEN {tlo} + _v % {thi - tlo + 1}"
        f" WHEN '{SENSOR_HUMIDITY}' THEN {hlo} + _v % {hhi - hlo + 1} ELSE _v END AS INT) AS value",
    )
