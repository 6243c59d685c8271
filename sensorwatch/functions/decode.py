"""Readings <-> JSON messages (Kafka ``key``/``value``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .timecols import epoch_text_to_time_sql

# Schema of the JSON value of a reading. ``timestamp`` is read as text so that
# both a JSON number (epoch seconds) and a quoted number are accepted.
READING_JSON_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("id", T.IntegerType(), True),
        T.StructField("sensor", T.StringType(), True),
        T.StructField("value", T.IntegerType(), True),
    ]
)
_READING_DDL = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in READING_JSON_SCHEMA.fields)


def decode_readings(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Kafka-style records -> readings ``timestamp TIMESTAMP, id INT, sensor STRING, value INT``.

    ``value`` may be binary or text. Parsing is permissive: malformed JSON gives
    a row of NULLs, a field of the wrong type (``25.5`` or ``"41"`` for an INT)
    gives NULL in that field only. The event time is the epoch seconds cut to
    whole seconds; unparsable or out-of-range times are NULL (such rows fall
    out of every window). One ``from_json`` per message; the fields are read
    from its struct.
    """
    parsed = messages.selectExpr(f"from_json(CAST(`{value_col}` AS STRING), '{_READING_DDL}') AS r")
    return parsed.selectExpr(
        f"{epoch_text_to_time_sql('r.`timestamp`')} AS timestamp",
        "r.id AS id",
        "r.sensor AS sensor",
        "r.value AS value",
    )


def encode_readings(readings: DataFrame) -> DataFrame:
    """Readings -> ``key STRING, value STRING`` as a sensor producer sends them.

    ``value`` is JSON ``{"timestamp": <epoch seconds, 6 decimals>, "id", "sensor",
    "value"}`` (NULL fields written as ``null``); ``key`` a random UUID, itself
    JSON-encoded (so quoted). Both columns are ready for the Kafka sink.
    """
    seconds = "CAST(CAST(unix_micros(`timestamp`) AS DECIMAL(26,0)) / 1000000 AS DECIMAL(20,6))"
    body = f"named_struct('timestamp', {seconds}, 'id', id, 'sensor', sensor, 'value', value)"
    return readings.selectExpr(
        "concat('\"', uuid(), '\"') AS key",
        f"to_json({body}, map('ignoreNullFields', 'false')) AS value",
    )
