"""Streaming jobs: readings -> watermark -> window averages -> rules -> alerts -> sinks.

The transforms are the batch ones (``operators``); this module adds the
watermark, the sources and the sinks. Every query needs its own checkpoint
folder: a second query started on another one's checkpoint treats the input
as already consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, AlertSettings
from ..functions.decode import decode_readings, encode_readings
from ..functions.messages import alert_messages
from ..operators.rule_join import match_rules
from ..operators.windows import window_averages
from ..sources.events import read_events_stream, readings_from_events
from ..sources.kafka import KafkaSettings, read_kafka_stream


def kafka_readings(spark: SparkSession, kafka: KafkaSettings, settings: AlertSettings = DEFAULT, **source_opts) -> DataFrame:
    """Decoded readings from the readings topic."""
    return decode_readings(read_kafka_stream(spark, kafka, settings.topics.readings, **source_opts))


def event_file_readings(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Readings from ``events.parquet`` (a file or a folder of files) in ``sf_dir`` as a stream, passed
    through the same JSON envelope a Kafka topic carries (encode, then decode).

    Without a file limit a backlog is one micro-batch, so no unread file is behind the watermark. A
    limit is only right if the files come in event-time order.
    """
    events = read_events_stream(spark, sf_dir, max_files_per_trigger)
    return decode_readings(encode_readings(readings_from_events(events, keep_fraction=True)))


def json_file_readings(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Readings from text files of JSON messages (one message per line), oldest file first.

    As for :func:`event_file_readings`, a limit is only right for files in event-time order.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.text(path)
    return decode_readings(raw)


def watermarked(readings: DataFrame, settings: AlertSettings = DEFAULT) -> DataFrame:
    return readings.withWatermark("timestamp", settings.watermark)


def averages_stream(readings: DataFrame, settings: AlertSettings = DEFAULT, by_sensor: bool = False) -> DataFrame:
    """Watermarked sliding-window averages (state kept until the watermark passes a window's end)."""
    return window_averages(watermarked(readings, settings), settings, by_sensor=by_sensor)


def alerts_stream(
    readings: DataFrame,
    rules: DataFrame,
    settings: AlertSettings = DEFAULT,
    by_sensor: bool = False,
) -> DataFrame:
    """Averages joined with the (static) rules; the rules file is re-read each micro-batch."""
    return match_rules(averages_stream(readings, settings, by_sensor), rules, settings)


def messages_stream(
    readings: DataFrame, rules: DataFrame, settings: AlertSettings = DEFAULT, sent_at=None
) -> DataFrame:
    return alert_messages(alerts_stream(readings, rules, settings), settings, sent_at)
