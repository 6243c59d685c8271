"""Named queries over the test tables, one per operator group of the survey.

Each takes ``(spark, sf_dir)`` and returns a DataFrame whose columns match the
DuckDB oracle of the same name (``plans.oracle``). Window bounds and event
times are given as UTC wall-clock ``TIMESTAMP_NTZ`` so that they compare with
DuckDB ``TIMESTAMP`` values whatever the session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, HOURLY, AlertSettings
from ..functions.decode import decode_readings, encode_readings
from ..functions.messages import alert_messages, route_topic
from ..functions.quarantine import decode_checked, write_quarantined
from ..functions.timecols import (
    epoch_text_to_time_sql,
    instant_to_utc_wall,
    instant_to_utc_wall_sql,
    utc_wall_to_instant,
    utc_wall_to_instant_sql,
)
from ..operators.rule_join import Axes, match_rules, rule_axes
from ..operators.windows import flatten_window, window_averages
from ..session import run_dir
from ..sources.events import read_events, read_events_stream, readings_from_events
from ..sources.rules import RULE_COLUMNS, inferred_differences, read_rules, read_rules_rescued
from ..streaming import alerts, jobs, monitor, sinks

# Fixed send time of the messages in the `alert_messages` query, so that the
# oracle can state the whole message.
PINNED_SENT_AT = "2025-03-04T05:06:07.089012"

QueryFn = Callable[[SparkSession, str], DataFrame]


#: Cuts of the packaged rules, which do not change while an application runs.
_PACKAGED_AXES: dict[tuple, Axes] = {}


def _match(averages: DataFrame, spark: SparkSession, settings: AlertSettings = DEFAULT) -> DataFrame:
    rules = read_rules(spark)
    version = (spark.sparkContext.applicationId, settings)
    if version not in _PACKAGED_AXES:
        _PACKAGED_AXES[version] = rule_axes(rules, settings)
    return match_rules(averages, rules, settings, _PACKAGED_AXES[version])


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(read_events(spark, sf_dir))


def decode_readings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> readings with fractional time -> JSON messages -> decoded readings."""
    fine = readings_from_events(read_events(spark, sf_dir), keep_fraction=True)
    out = decode_readings(encode_readings(fine))
    return out.select(instant_to_utc_wall(F.col("timestamp")).alias("timestamp"), "id", "sensor", "value")


def decode_event_time_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds as the text a JSON number arrives as (``1.704067798778549E9``) -> event time."""
    events = read_events(spark, sf_dir)
    text = f"CAST(CAST(unix_micros({utc_wall_to_instant_sql('ts')}) / 1000000 AS DOUBLE) AS STRING)"
    return events.selectExpr("event_id", f"{instant_to_utc_wall_sql(epoch_text_to_time_sql(text))} AS event_time")


def encode_readings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> readings with fractional time -> JSON value on the readings topic; of the random key, its shape."""
    fine = readings_from_events(read_events(spark, sf_dir), keep_fraction=True)
    return encode_readings(fine).select(
        F.lit(DEFAULT.topics.readings).alias("topic"),
        "value",
        F.length("key").alias("key_length"),
        F.col("key").rlike('^"[0-9a-f-]+"$').alias("key_quoted"),
    )


def _window_avg(settings: AlertSettings, by_sensor: bool = False) -> QueryFn:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flatten_window(window_averages(_readings(spark, sf_dir), settings, by_sensor=by_sensor))

    return q


def _alerts(settings: AlertSettings, by_sensor: bool = False) -> QueryFn:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        averages = window_averages(_readings(spark, sf_dir), settings, by_sensor=by_sensor)
        return flatten_window(_match(averages, spark, settings))

    return q


def alert_routing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = window_averages(_readings(spark, sf_dir), DEFAULT)
    alerts = flatten_window(_match(averages, spark))
    return alerts.select("window_start", "window_end", "id", "code", route_topic(F.col("code")).alias("topic"))


def alert_messages_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = AlertSettings(message_time_zone="UTC")
    averages = window_averages(_readings(spark, sf_dir), settings)
    return alert_messages(_match(averages, spark, settings), settings, sent_at=PINNED_SENT_AT)


# --- streaming: events files as a stream, drained with an availableNow trigger


def _state_partitions(spark: SparkSession) -> int:
    # one state partition per core of the cluster; fixed for the life of a checkpoint
    return spark.sparkContext.defaultParallelism


def _start_update_changelog(spark: SparkSession, averages: DataFrame, base: str):
    # every fifth batch makes a snapshot; readers take the latest one and the batches after it
    return sinks.start_changelog(
        averages, f"{base}/changelog", f"{base}/checkpoint", "update", state_partitions=_state_partitions(spark),
        compact_keys=["window"], compact_every=5,
    )


def _drain(query, late: bool = False) -> None:
    """Wait for an availableNow run; unless ``late`` rows are meant to be, none may have been dropped by the watermark."""
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise query.exception()
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    if dropped and not late:
        raise RuntimeError(f"{dropped} rows came behind the watermark; take the files in event-time order or without a limit")


def stream_window_avg_update_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode averages, each batch appended to a changelog; the newest version per window."""
    base = run_dir(spark, "stream_window_avg_update")
    averages = jobs.averages_stream(jobs.event_file_readings(spark, sf_dir), DEFAULT)
    _drain(_start_update_changelog(spark, averages, base))
    return flatten_window(sinks.read_current(spark, f"{base}/changelog", averages.schema, ["window"]))


def stream_alerts_update_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode without stale alerts: upsert the averages by window, derive alerts from that table."""
    base = run_dir(spark, "stream_alerts_update")
    averages = jobs.averages_stream(jobs.event_file_readings(spark, sf_dir), DEFAULT)
    _drain(_start_update_changelog(spark, averages, base))
    current = sinks.read_current(spark, f"{base}/changelog", averages.schema, ["window"])
    return flatten_window(_match(current, spark))


def stream_alerts_append_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: each (rule, window) once, after the watermark passes the window's end."""
    base = run_dir(spark, "stream_alerts_append")
    found = jobs.alerts_stream(jobs.event_file_readings(spark, sf_dir), read_rules(spark), DEFAULT)
    _drain(sinks.start_table(found, f"{base}/table", f"{base}/checkpoint", state_partitions=_state_partitions(spark)))
    return flatten_window(spark.read.schema(found.schema).parquet(f"{base}/table"))


def stream_alerts_by_sensor_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode, windows per sensor: each (rule, window, sensor) once the watermark passes the window's end."""
    base = run_dir(spark, "stream_alerts_by_sensor")
    readings = jobs.event_file_readings(spark, sf_dir)
    found = jobs.alerts_stream(readings, read_rules(spark), DEFAULT, by_sensor=True)
    _drain(sinks.start_table(found, f"{base}/table", f"{base}/checkpoint", state_partitions=_state_partitions(spark), state_store=sinks.ROCKSDB_PROVIDER))
    return flatten_window(spark.read.schema(found.schema).parquet(f"{base}/table"))


# Fixed values of the late-data scenario: an event is delivered floor(value)
# minutes after its time, and deliveries are processed in runs of 5 days of
# arrival time.
LATE_DELAY_UNIT_SECONDS = 60
LATE_BATCH_SECONDS = 5 * 86_400


def _arrival_period() -> Column:
    sent = F.unix_micros(utc_wall_to_instant("ts"))
    delay = F.floor(F.coalesce(F.col("value"), F.lit(0.0))) * F.lit(LATE_DELAY_UNIT_SECONDS * 1_000_000)
    return F.floor((sent + delay).cast("double") / F.lit(float(LATE_BATCH_SECONDS * 1_000_000)))


def _deliveries(spark: SparkSession, sf_dir: str, base: str, number: Column) -> list[tuple[int, DataFrame]]:
    """Events in deliveries: staged once, partitioned by ``number``; each delivery reads its own partition (events scanned once in all).

    Only the numbers come to the driver, one small value per delivery.
    """
    timed = read_events(spark, sf_dir).where("ts IS NOT NULL").withColumn("_delivery", number)
    timed.repartition("_delivery", F.pmod(F.xxhash64("event_id"), F.lit(8))).write.partitionBy("_delivery").parquet(f"{base}/staged")
    staged = spark.read.parquet(f"{base}/staged")
    numbers = [r[0] for r in staged.select("_delivery").distinct().orderBy("_delivery").collect()]
    return [(n, staged.where(F.col("_delivery") == n).drop("_delivery")) for n in numbers]


def _deliver(spark: SparkSession, events: DataFrame, base: str) -> DataFrame:
    """Append one delivery to the input folder; the folder's readings as a stream."""
    events.write.mode("append").parquet(f"{base}/input")
    return readings_from_events(read_events_stream(spark, f"{base}/input", None, "*.parquet"))


def stream_late_data_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late data: events arrive by delivery time, one ``availableNow`` run per delivery period.

    Each run appends that period's events to the input folder and drains it
    into the same checkpointed stream. An event delivered after the watermark
    (newest event time of earlier runs minus the delay) has passed the end of
    one of its windows is dropped for that window. Result: the newest
    averages per window (update-mode changelog).
    """
    base = run_dir(spark, "stream_late_data")
    schema = None
    # an event without a value comes without delay, one without a time is in no window
    for _, events in _deliveries(spark, sf_dir, base, _arrival_period()):
        averages = jobs.averages_stream(_deliver(spark, events, base), DEFAULT)
        schema = averages.schema
        _drain(_start_update_changelog(spark, averages, base), late=True)
    return flatten_window(sinks.read_current(spark, f"{base}/changelog", schema, ["window"]))


def stream_late_audit_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`stream_late_data_q`'s runs dropped: windows behind the watermark per run, and the watermark in force.

    A listener writes every progress event to a table; a late window counts once
    a run, however many of its readings come late.
    """
    base = run_dir(spark, "stream_late_audit")
    runs = []
    with monitor.ProgressLog(spark, f"{base}/progress") as log:
        for n, (period, events) in enumerate(_deliveries(spark, sf_dir, base, _arrival_period())):
            averages = jobs.averages_stream(_deliver(spark, events, base), DEFAULT)
            query = _start_update_changelog(spark, averages, base)
            _drain(query, late=True)
            log.wait_for(query)
            runs.append((str(query.runId), n, int(period)))
    numbered = spark.createDataFrame(runs, "run_id string, run int, period long")
    events = log.table().join(F.broadcast(numbered), "run_id")
    # the run's readings come in its first batch; the one after it only moves the watermark
    return events.groupBy("run", "period").agg(
        instant_to_utc_wall(F.min("watermark")).alias("watermark"),
        F.sum("dropped_rows").alias("windows_dropped"),
        F.sum("input_rows").alias("readings"),
    )


# Fixed values of the event-time scenario: events are delivered in order, 5 days
# a run; windows of 10 days each 5 days, so two runs touch most windows.
EMITTED = AlertSettings(window="10 days", slide="5 days")
EMITTED_RUN_SECONDS = 5 * 86_400


def _event_period() -> Column:
    return F.floor(F.unix_micros(utc_wall_to_instant("ts")) / F.lit(EMITTED_RUN_SECONDS * 1_000_000))


def stream_alerts_emitted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode alerts, the rules joined inside the stream, every emission kept with its micro-batch.

    Events come in event-time order, one ``availableNow`` run per 5 days on one
    checkpoint; a window per sensor is emitted again by each run that adds
    readings to it, with the rules that fire for its averages up to then.
    ``emission`` numbers the micro-batches that had readings.
    """
    base = run_dir(spark, "stream_alerts_emitted")
    parts, schema = [], None
    for n, (_, events) in enumerate(_deliveries(spark, sf_dir, base, _event_period())):
        emitted = jobs.alerts_stream(_deliver(spark, events, base), read_rules(spark), EMITTED, by_sensor=True)
        schema = emitted.schema
        query = sinks.start_changelog(
            emitted, f"{base}/changelog", f"{base}/checkpoint", "update",
            state_partitions=_state_partitions(spark), state_store=sinks.ROCKSDB_PROVIDER,
        )
        _drain(query)
        parts += [(p.batchId, n) for p in query.recentProgress if p.numInputRows]
    batches = spark.createDataFrame(parts, "batch_id int, emission int")
    log = sinks.read_changelog(spark, f"{base}/changelog", schema).join(F.broadcast(batches), "batch_id")
    return flatten_window(log.select("window", "sensor_id", "id", "code", *[f"avg_{m}" for m in EMITTED.measures], "emission"))


def stream_alert_transitions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When alerts are raised and taken back, over the runs of :func:`stream_alerts_emitted_q`: a row per change only."""
    base = run_dir(spark, "stream_alert_transitions")
    parts, schema = [], None
    for n, (_, events) in enumerate(_deliveries(spark, sf_dir, base, _event_period())):
        changes = alerts.transitions(_deliver(spark, events, base), read_rules(spark), EMITTED, by_sensor=True)
        schema = changes.schema
        query = alerts.start_transitions(changes, f"{base}/changelog", f"{base}/checkpoint", _state_partitions(spark))
        _drain(query)
        parts += [(p.batchId, n) for p in query.recentProgress if p.numInputRows]
    batches = spark.createDataFrame(parts, "batch_id int, emission int")
    log = sinks.read_changelog(spark, f"{base}/changelog", schema).join(F.broadcast(batches), "batch_id")
    return flatten_window(log.drop("batch_id"))


def stream_state_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows per sensor that a drained stream still keeps, with their partial sums, read from its checkpoint."""
    base = run_dir(spark, "stream_state_rows")
    averages = jobs.averages_stream(jobs.event_file_readings(spark, sf_dir), EMITTED, by_sensor=True)
    query = sinks.start_changelog(
        averages, f"{base}/changelog", f"{base}/checkpoint", "update",
        state_partitions=_state_partitions(spark), state_store=sinks.ROCKSDB_PROVIDER,
    )
    _drain(query)
    return flatten_window(monitor.state_rows(spark, f"{base}/checkpoint", EMITTED, by_sensor=True))


class _Crash(Exception):
    pass


def stream_publish_once_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of append-mode alerts, published through three runs: one that fails between the output and the
    ledger, its restart, and one whose checkpoint is lost, so that all input comes again."""
    base = run_dir(spark, "stream_publish_once")
    settings = AlertSettings(message_time_zone="UTC")

    def crash(batch_id: int) -> None:
        raise _Crash(f"after the output of batch {batch_id}")

    def run(checkpoint: str, after_write=None):
        found = jobs.alerts_stream(jobs.event_file_readings(spark, sf_dir), read_rules(spark), settings)
        return alerts.start_publish_once(
            found, lambda rows: alert_messages(rows, settings, sent_at=PINNED_SENT_AT), f"{base}/published",
            f"{base}/{checkpoint}", settings, after_write, state_partitions=_state_partitions(spark),
        )

    try:
        run("first", crash).awaitTermination()
    except StreamingQueryException as error:
        if "after the output of batch" not in str(error):
            raise
    _drain(run("first"))
    _drain(run("second"))
    return spark.read.schema("topic string, value string").parquet(f"{base}/published/messages").select("topic", "value")


def supplier_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per supplier, by a fixed rule: narrow bounds on one axis or both, some far-off, some fractional, some none."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    k = "s_suppkey"
    return suppliers.selectExpr(
        f"CAST({k} AS INT) AS id",
        f"CAST(CASE WHEN {k} % 3 = 0 THEN -999 ELSE 15 + {k} * 13 % 71 END AS DOUBLE) AS humidity_min",
        f"CAST(CASE WHEN {k} % 3 = 0 THEN -999 WHEN {k} % 10 = 7 THEN 1000000 ELSE 18.5 + {k} * 13 % 71 END AS DOUBLE) AS humidity_max",
        f"CAST(CASE WHEN {k} % 3 = 1 OR {k} % 50 = 0 THEN -999 ELSE 25 + {k} * 7 % 21 END AS DOUBLE) AS temperature_min",
        f"CAST(CASE WHEN {k} % 3 = 1 OR {k} % 50 = 0 THEN -999 ELSE 26.5 + {k} * 7 % 21 END AS DOUBLE) AS temperature_max",
        "100 + s_nationkey AS code",
        "s_name AS message",
    )


def supplier_rule_hits_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many windows fire each of many rules, and the first and last of them."""
    averages = window_averages(_readings(spark, sf_dir), DEFAULT)
    alerts = flatten_window(match_rules(averages, supplier_rules(spark, sf_dir)))
    return alerts.groupBy("id", "code").agg(
        F.count("*").alias("n_windows"), F.min("window_start").alias("first_start"), F.max("window_start").alias("last_start")
    )


def supplier_rules_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier rules written as CSV files, some cells damaged by a fixed rule, read back by explicit types
    with rescued cells and by inference."""
    path = run_dir(spark, "supplier_rules_csv")
    damaged = supplier_rules(spark, sf_dir).selectExpr(
        "id",
        "IF(id % 17 = 3, 'n/a', CAST(humidity_min AS STRING)) AS humidity_min",
        "humidity_max", "temperature_min", "temperature_max",
        "IF(id % 23 = 5, concat(CAST(code AS STRING), '.5'), CAST(code AS STRING)) AS code",
        "message",
    )
    damaged.repartition(4, "id").write.option("header", "true").csv(path)
    types = ", ".join(f"{c} {t}" for c, t in sorted(inferred_differences(spark, path).items()))
    rows = read_rules_rescued(spark, path)
    inferred = read_rules(spark, path, infer_schema=True).selectExpr("id", "CAST(humidity_min AS STRING) AS inferred_humidity_min")
    rescued = "concat_ws(', ', transform(map_entries(rescued), e -> concat(e.key, '=', e.value))) AS rescued"
    return rows.join(inferred, "id").selectExpr(
        *RULE_COLUMNS, rescued, "inferred_humidity_min", f"'{types}' AS inferred_types"
    )


def drifting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of ``events`` as messages; by a fixed rule some change a field's type, break off, or are the event's ``props``."""
    fine = readings_from_events(read_events(spark, sf_dir).withColumn("user_id", F.col("event_id")), keep_fraction=True)
    kind = F.expr(
        "CASE WHEN id % 13 = 5 THEN 'cut' WHEN id % 11 = 3 THEN 'fraction' WHEN id % 7 = 1 THEN 'quoted'"
        " WHEN id % 17 = 2 THEN 'time' WHEN id % 19 = 4 THEN 'other' WHEN id % 101 = 7 THEN 'list' ELSE 'whole' END"
    )
    messages = encode_readings(fine.where("id IS NOT NULL")).select("value", F.get_json_object("value", "$.id").cast("long").alias("id"))
    messages = messages.withColumn("kind", kind)
    number = r"regexp_replace(value, '\"value\":(-?[0-9]+|null)',"
    drift = F.expr(
        "CASE kind WHEN 'cut' THEN left(value, length(value) - 5)"
        f" WHEN 'fraction' THEN {number} '\"value\":0.5')"
        f" WHEN 'quoted' THEN {number} '\"value\":\"$1\"')"
        r" WHEN 'time' THEN regexp_replace(value, '\"timestamp\":[0-9.]+', '\"timestamp\":\"soon\"')"
        " WHEN 'other' THEN concat('{\"k\":', id, '}') WHEN 'list' THEN concat('[', id, ']') ELSE value END"
    )
    return messages.select(F.col("id").alias("event_id"), drift.alias("value"))


def decode_quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose shape drifts, decoded with one parse: accepted readings and dead letters counted by cause."""
    decoded = decode_checked(drifting_messages(spark, sf_dir))
    accepted, dead = write_quarantined(decoded, run_dir(spark, "decode_quarantine"))
    rows = accepted.select(F.lit("accepted").alias("cause"), "event_id", "value").unionByName(
        dead.select(F.explode("causes").alias("cause"), "event_id", "value")
    )
    return rows.groupBy("cause").agg(
        F.count("*").alias("messages"), F.sum("event_id").alias("event_ids"), F.sum("value").alias("values"), F.max("event_id").alias("newest")
    )


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per part, by a fixed rule: narrow, mostly different bounds on both axes."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    humidity, temperature = "15 + (p_partkey * 37 % 7000) / 100D", "25 + (p_partkey * 53 % 2000) / 100D"
    return parts.selectExpr(
        "CAST(p_partkey AS INT) AS id",
        f"{humidity} AS humidity_min",
        f"{humidity} + 2 + p_size / 10D AS humidity_max",
        f"{temperature} AS temperature_min",
        f"{temperature} + 1 + p_size / 20D AS temperature_max",
        "100 + p_size AS code",
        "p_name AS message",
    )


def part_rule_hits_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`supplier_rule_hits_q`, for a rule per part, each bounded on both axes, over hourly windows."""
    averages = window_averages(_readings(spark, sf_dir), HOURLY)
    alerts = flatten_window(match_rules(averages, part_rules(spark, sf_dir)))
    return alerts.groupBy("id", "code", "message").agg(
        F.count("*").alias("n_windows"),
        F.min("window_start").alias("first_start"),
        F.max("avg_humidity").alias("max_humidity"),
        F.max("avg_temperature").alias("max_temperature"),
    )


QUERIES: dict[str, QueryFn] = {
    "decode_readings": decode_readings_q,
    "decode_event_time": decode_event_time_q,
    "encode_readings": encode_readings_q,
    "window_avg": _window_avg(DEFAULT),
    "window_avg_hourly": _window_avg(HOURLY),
    "window_avg_by_sensor": _window_avg(DEFAULT, by_sensor=True),
    "alerts": _alerts(DEFAULT),
    "alerts_hourly": _alerts(HOURLY),
    "alerts_by_sensor": _alerts(DEFAULT, by_sensor=True),
    "alert_routing": alert_routing_q,
    "alert_messages": alert_messages_q,
    "stream_window_avg_update": stream_window_avg_update_q,
    "stream_alerts_update": stream_alerts_update_q,
    "stream_alerts_append": stream_alerts_append_q,
    "stream_alerts_by_sensor": stream_alerts_by_sensor_q,
    "stream_late_data": stream_late_data_q,
    "stream_alerts_emitted": stream_alerts_emitted_q,
    "stream_late_audit": stream_late_audit_q,
    "stream_alert_transitions": stream_alert_transitions_q,
    "stream_state_rows": stream_state_rows_q,
    "stream_publish_once": stream_publish_once_q,
    "supplier_rule_hits": supplier_rule_hits_q,
    "part_rule_hits": part_rule_hits_q,
    "supplier_rules_csv": supplier_rules_csv_q,
    "decode_quarantine": decode_quarantine_q,
}
