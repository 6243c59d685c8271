"""Command line for the streaming jobs.

    python -m sensorwatch rules    [--rules PATH]                 # print the alert rules table
    python -m sensorwatch produce  --path DIR --sink kafka        # readings of an events table -> readings topic
    python -m sensorwatch readings --source kafka                 # decoded readings -> console (append)
    python -m sensorwatch averages --source kafka                 # window averages -> console (update)
    python -m sensorwatch alerts   --source kafka                 # alerts -> console (update)
    python -m sensorwatch publish  --source kafka --sink kafka    # alert messages -> Kafka topics (append)

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
``spark.jars.packages`` (the Kafka connector) and the rest are given the usual
way (``PYSPARK_SUBMIT_ARGS``, ``spark-defaults.conf``).

Sources: ``kafka`` (readings topic; broker and login from ``SENSORWATCH_KAFKA_*``
environment variables), ``json`` (folder of JSON-lines files, one message per
line), ``events`` (folder holding ``events*.parquet``). Sinks: ``console``,
``table`` (parquet folder, append), ``changelog`` (parquet folder, one
``batch_id=<n>`` folder per micro-batch; update or append), ``kafka``.
``--once`` drains what is available and stops (availableNow); otherwise the
query runs until stopped, every ``--interval`` if given.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    SLIDE_DURATION,
    UNUSED_BOUND,
    WATERMARK_DELAY,
    WINDOW_DURATION,
    AlertSettings,
    Topics,
)
from ..functions.decode import encode_readings
from ..functions.messages import alert_messages
from ..operators.rule_join import match_rules
from ..session import run_dir
from ..sources.events import read_events, readings_from_events
from ..sources.kafka import KafkaSettings
from ..sources.rules import read_rules
from . import jobs, sinks


ROCKSDB_PROVIDER = sinks.ROCKSDB_PROVIDER


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sensorwatch", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=["rules", "produce", "readings", "averages", "alerts", "publish"])
    p.add_argument("--source", choices=["kafka", "json", "events"], default="kafka")
    p.add_argument("--path", help="input folder for --source json/events")
    p.add_argument("--sink", choices=["console", "table", "changelog", "kafka"])
    p.add_argument("--out", help="output folder for --sink table/changelog")
    p.add_argument("--mode", choices=["update", "append"], help="output mode (default: update, append for table/kafka)")
    p.add_argument("--checkpoint", help="checkpoint folder (default: new folder under spark.checkpoint.dir)")
    p.add_argument("--rules", help="rules CSV (default: the packaged four rules)")
    p.add_argument("--infer-schema", action="store_true", help="infer the rules CSV schema instead of the fixed one")
    p.add_argument("--window", default=WINDOW_DURATION)
    p.add_argument("--slide", default=SLIDE_DURATION)
    p.add_argument("--watermark", default=WATERMARK_DELAY)
    p.add_argument("--unused-bound", type=int, default=UNUSED_BOUND)
    p.add_argument("--by-sensor", action="store_true", help="group by sensor id as well")
    p.add_argument("--topic-prefix", help="topics named <prefix>_building_sensors, …")
    p.add_argument("--message-time-zone", help="zone of the window times in alert messages (default: session zone)")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--min-partitions", type=int, help="Kafka: split each micro-batch over at least this many tasks")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument(
        "--state-store",
        choices=["default", "rocksdb"],
        default="default",
        help="rocksdb keeps window state off the JVM heap (for --by-sensor with many sensors)",
    )
    p.add_argument("--state-partitions", type=int, help="state partitions of a new checkpoint (default: shuffle partitions)")
    p.add_argument("--once", action="store_true", help="availableNow: process what is there, then stop")
    p.add_argument("--interval", help="processing-time trigger, e.g. '30 seconds'")
    return p


def _readings(spark: SparkSession, args, settings: AlertSettings) -> DataFrame:
    if args.source == "kafka":
        opts = {}
        if args.max_offsets_per_trigger:
            opts["max_offsets_per_trigger"] = args.max_offsets_per_trigger
        if args.min_partitions:
            opts["min_partitions"] = args.min_partitions
        return jobs.kafka_readings(spark, KafkaSettings.from_env(), settings, **opts)
    if not args.path:
        raise SystemExit(f"--path is required for --source {args.source}")
    if args.source == "json":
        return jobs.json_file_readings(spark, args.path, args.max_files_per_trigger)
    return jobs.event_file_readings(spark, args.path, args.max_files_per_trigger)


def build(spark: SparkSession, args) -> tuple[DataFrame, str, str]:
    """The streaming DataFrame of a job, its sink and its output mode."""
    settings = AlertSettings(
        window=args.window,
        slide=args.slide,
        watermark=args.watermark,
        unused_bound=args.unused_bound,
        topics=Topics.with_prefix(args.topic_prefix) if args.topic_prefix else Topics(),
        message_time_zone=args.message_time_zone,
    )
    readings = _readings(spark, args, settings)
    if args.job == "readings":
        sink = args.sink or "console"
        return readings, sink, args.mode or "append"
    averages = jobs.averages_stream(readings, settings, by_sensor=args.by_sensor)
    if args.job == "averages":
        df = averages
    else:
        rules = read_rules(spark, args.rules, infer_schema=args.infer_schema)
        df = match_rules(averages, rules, settings)
        if args.job == "publish":
            df = alert_messages(df, settings)
    sink = args.sink or ("kafka" if args.job == "publish" else "console")
    mode = args.mode or ("append" if sink in ("table", "kafka") else "update")
    return df, sink, mode


def produce(spark: SparkSession, args):
    """Batch job: readings derived from ``<path>/events.parquet`` -> JSON messages on the readings topic.

    Each reading becomes one message (random quoted UUID key, JSON value with
    the time as epoch seconds), written by the Kafka sink in parallel from
    every partition, or appended to a parquet folder with ``--sink table``.
    """
    if not args.path:
        raise SystemExit("--path is required for produce")
    topics = Topics.with_prefix(args.topic_prefix) if args.topic_prefix else Topics()
    readings = readings_from_events(read_events(spark, args.path), keep_fraction=True)
    messages = encode_readings(readings).withColumn("topic", F.lit(topics.readings))
    sink = args.sink or "kafka"
    if sink == "kafka":
        messages.write.format("kafka").options(**KafkaSettings.from_env().options()).save()
    elif sink == "table":
        if not args.out:
            raise SystemExit("--out is required for --sink table")
        messages.write.mode("append").parquet(args.out)
    else:
        raise SystemExit(f"produce writes to kafka or table, not {sink}")
    return messages


def _refuse_unsupported(args) -> None:
    """Jobs, sinks and modes that do not go together."""
    if args.sink == "kafka" and args.job in ("readings", "averages", "alerts"):
        raise SystemExit(f"--sink kafka takes messages (job publish or produce), not {args.job}")
    if args.mode == "update" and (args.sink in ("table", "kafka") or (args.job == "publish" and not args.sink)):
        raise SystemExit("--mode update needs the sink console or changelog; tables and topics are append only")


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    args = _parser().parse_args(argv)
    _refuse_unsupported(args)
    spark = spark or SparkSession.builder.appName(f"sensorwatch-{args.job}").getOrCreate()
    if args.state_store == "rocksdb":
        # read when a stateful query starts; a restarted query keeps the provider of its checkpoint
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    if args.job == "produce":
        return produce(spark, args)
    if args.job == "rules":
        rules = read_rules(spark, args.rules, infer_schema=args.infer_schema)
        rules.show(truncate=False)
        return rules
    df, sink, mode = build(spark, args)
    checkpoint = args.checkpoint or f"{run_dir(spark, args.job)}/checkpoint"
    trig = {"available_now": args.once, "processing_time": args.interval, "state_partitions": args.state_partitions}
    if sink == "console":
        q = sinks.start_console(df, checkpoint, mode, **trig)
    elif sink == "kafka":
        q = sinks.start_kafka(df, KafkaSettings.from_env(), checkpoint, **trig)
    else:
        if not args.out:
            raise SystemExit(f"--out is required for --sink {sink}")
        if sink == "table":
            q = sinks.start_table(df, args.out, checkpoint, **trig)
        else:
            q = sinks.start_changelog(df, args.out, checkpoint, mode, **trig)
    q.awaitTermination()
    return q
