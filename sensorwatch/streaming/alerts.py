"""Alerts of update-mode streams: per batch with hot nodes dealt out, as raised / cleared transitions, and published once.

* :func:`start_alerts` joins the rules batch by batch, as a batch job: nodes of
  the rule join that held a large share of the last batch's windows are dealt
  over salts, so no task gets a third of all rows, whatever the join's form.
* :func:`transitions` keeps each window's sums and the rules that fire for it in
  state, a row per window and group of sensors, and emits a row only when a rule
  starts or stops firing.
* :func:`start_publish_once` keeps a ledger of message keys beside the output, so a
  replayed batch, or a restart without checkpoint, publishes nothing twice.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..config import DEFAULT, AlertSettings
from ..operators.rule_join import hot_nodes, match_rules, rule_axes
from .sinks import CHANGELOG_COLUMN, ROCKSDB_PROVIDER, _start, _trigger, read_changelog


# the processor travels by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def start_alerts(
    averages: DataFrame,
    rules: DataFrame,
    path: str,
    checkpoint: str,
    settings: AlertSettings = DEFAULT,
    output_mode: str = "update",
    available_now: bool = True,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Write each micro-batch's averages to ``path/averages`` and its alerts to ``path/alerts``, a folder per batch.

    The hot nodes of a batch are those of the last batch with rows before it (read
    from its folder after a restart); they change how the join is dealt out, not its rows.
    """
    spark, schema, last = averages.sparkSession, averages.schema, {}

    def before(batch_id: int) -> DataFrame | None:
        """The averages of the newest batch with rows before this one, found once after a start."""
        log = read_changelog(spark, f"{path}/averages", schema).where(F.col(CHANGELOG_COLUMN) < batch_id)
        newest = log.agg(F.max(CHANGELOG_COLUMN)).first()[0] if batch_id else None
        return None if newest is None else log.where(F.col(CHANGELOG_COLUMN) == newest).drop(CHANGELOG_COLUMN)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = f"{path}/averages/{CHANGELOG_COLUMN}={batch_id}"
        batch.write.mode("overwrite").parquet(own)
        rows = spark.read.schema(schema).parquet(own)
        axes = rule_axes(rules, settings)  # rules may change between batches
        if "windows" not in last:
            last["windows"] = before(batch_id)
        hot = hot_nodes(last["windows"], axes, settings) if last["windows"] is not None else []
        alerts = match_rules(rows, rules, settings, axes, hot)
        alerts.write.mode("overwrite").parquet(f"{path}/alerts/{CHANGELOG_COLUMN}={batch_id}")
        if rows.limit(1).count():  # a batch that only moves the watermark says nothing
            last["windows"] = rows

    writer = averages.writeStream.outputMode(output_mode).foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(averages, _trigger(writer, available_now, processing_time), state_partitions)


#: Rules that a transitions query takes to its tasks; a table of more is refused.
MOST_RULES = 10_000


#: Groups of sensors in a window; a group's sensors share a state row, so calls to the state do not grow with the sensors.
#: Fixed for the life of a checkpoint.
SENSOR_GROUPS = 512
#: Stands for a sensor without id.
_NO_ID = -(1 << 63)


class _Transitions(StatefulProcessor):
    """State of a window's group of sensors, each as an array: ids (ascending), sums and counts per measure, which rules fire.

    A timer ends it when the watermark has passed.
    """

    def __init__(self, rules: list[tuple], measures: tuple[str, ...], unused: float, by_sensor: bool):
        self.rules, self.measures, self.unused, self.by_sensor = rules, measures, unused, by_sensor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sensors", "ids binary, totals binary, sizes binary, firing binary")

    def _fires(self, averages: np.ndarray) -> Iterator[np.ndarray]:
        """Per rule the rows for which it fires; a used bound fails on NaN."""
        for bounds in self.rules:
            holds = np.ones(len(averages), dtype=bool)
            for i, (lo, hi) in enumerate(bounds[2:]):
                if lo != self.unused:
                    holds &= averages[:, i] >= lo
                if hi != self.unused:
                    holds &= averages[:, i] <= hi
            yield np.flatnonzero(holds)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        width, times = 2 * len(self.measures), max(1, len(self.rules))
        parts = [f[["sensor", "measure", "value"]].to_numpy(np.int64) for f in rows]
        sensor, measure, value = np.concatenate(parts).T
        touched = np.unique(sensor)
        old = self.state.get()
        if old is None:
            self.handle.registerTimer(key[1])
            ids, totals, before = touched, np.zeros((len(touched), width), dtype=np.int64), np.zeros(0, dtype=np.int64)
        else:
            known = np.frombuffer(old[0], dtype=np.int64)
            ids = np.union1d(known, touched)
            place = np.searchsorted(ids, known)
            totals = np.zeros((len(ids), width), dtype=np.int64)
            totals[place] = np.frombuffer(old[1], dtype=np.int64).reshape(-1, width)
            # a firing rule is one number: the sensor's place times the number of rules, and the rule's number
            before = np.repeat(place, np.frombuffer(old[2], dtype=np.int32)) * times + np.frombuffer(old[3], dtype=np.int32)
        measured = measure >= 0
        at, column = np.searchsorted(ids, sensor[measured]), 2 * measure[measured]
        np.add.at(totals, (at, column), value[measured])
        np.add.at(totals, (at, column + 1), 1)
        here = np.searchsorted(ids, touched)
        sums, counts = totals[:, 0::2], totals[:, 1::2]
        averages = np.where(counts > 0, sums / np.maximum(counts, 1), np.nan)
        fired = [here[w] * times + n for n, w in enumerate(self._fires(averages[here]))]
        now = np.sort(np.concatenate(fired)) if fired else np.zeros(0, dtype=np.int64)
        again = np.isin(before // times, here)
        changes = np.setxor1d(before[again], now)
        firing = np.sort(np.concatenate([before[~again], now]))
        sizes = np.bincount(firing // times, minlength=len(ids)).astype(np.int32)
        self.state.update((ids.tobytes(), totals.tobytes(), sizes.tobytes(), (firing % times).astype(np.int32).tobytes()))
        if not len(changes):
            return
        who, which = changes // times, (changes % times).tolist()
        out = {"window_start": np.full(len(who), key[0]), "window_end": np.full(len(who), key[1])}
        if self.by_sensor:
            out["sensor_id"] = pd.array([None if i == _NO_ID else i for i in ids[who].tolist()], dtype="Int64")
        out["id"] = pd.array([self.rules[n][0] for n in which], dtype="Int64")
        out["code"] = pd.array([self.rules[n][1] for n in which], dtype="Int64")
        out["change"] = np.where(np.isin(changes, now), "raised", "cleared")
        for i, m in enumerate(self.measures):
            out[f"avg_{m}"] = averages[who, i]
        yield pd.DataFrame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def transitions(readings: DataFrame, rules: DataFrame, settings: AlertSettings = DEFAULT, by_sensor: bool = False) -> DataFrame:
    """INT readings (a stream) -> ``window, [sensor_id], id, code, change, avg_<m>...``, a row per change.

    ``change`` is ``raised`` when a rule starts to fire for a window and
    ``cleared`` when a later reading makes it stop. The rules are those at the
    start, at most ``MOST_RULES`` of them. Start it in update mode with the
    RocksDB state store (:func:`start_transitions`).
    """
    measures = settings.measures
    bounds = [f"{m}_{e}" for m in measures for e in ("min", "max")]
    table = rules.where(" AND ".join(f"`{b}` IS NOT NULL" for b in bounds)).select("id", "code", *bounds)
    held = table.orderBy("id", "code", *bounds).limit(MOST_RULES + 1).collect()
    if len(held) > MOST_RULES:
        raise ValueError(f"transitions take at most {MOST_RULES} rules")
    values = [(r[0], r[1], *[(float(r[2 + 2 * i]), float(r[3 + 2 * i])) for i in range(len(measures))]) for r in held]
    timed = readings.withWatermark("timestamp", settings.watermark)
    window = F.window("timestamp", settings.window, settings.slide).alias("window")
    measure = F.coalesce(*[F.when((F.col("sensor") == m) & F.col("value").isNotNull(), F.lit(i)) for i, m in enumerate(measures)])
    # the window itself stays beside the keys: it carries the watermark by which late rows are dropped
    sensor = F.coalesce(F.col("id").cast("long"), F.lit(_NO_ID)) if by_sensor else F.lit(0).cast("long")
    value = F.coalesce(F.col("value").cast("long"), F.lit(0))
    rows = timed.select(window, sensor.alias("sensor"), F.coalesce(measure, F.lit(-1)).alias("measure"), value.alias("value"))
    rows = rows.withColumns({"window_start": F.unix_millis("window.start"), "window_end": F.unix_millis("window.end")})
    rows = rows.withColumn("group", F.pmod(F.xxhash64("sensor"), F.lit(SENSOR_GROUPS)) if by_sensor else F.lit(0).cast("long"))
    schema = T.StructType().add("window_start", T.LongType()).add("window_end", T.LongType())
    if by_sensor:
        schema = schema.add("sensor_id", readings.schema["id"].dataType)
    schema = schema.add("id", T.IntegerType()).add("code", T.IntegerType()).add("change", T.StringType())
    for m in measures:
        schema = schema.add(f"avg_{m}", T.DoubleType())
    processor = _Transitions(values, measures, float(settings.unused_bound), by_sensor)
    out = rows.groupBy("window_start", "window_end", "group").transformWithStateInPandas(processor, schema, "Update", "EventTime")
    bounds = "named_struct('start', timestamp_millis(window_start), 'end', timestamp_millis(window_end)) AS window"
    return out.selectExpr(bounds, *out.columns[2:])


def start_transitions(changes: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None, **trigger) -> StreamingQuery:
    """Every batch's changes to ``path/batch_id=<n>``, with the state in RocksDB (which this operator needs)."""
    from .sinks import start_changelog

    return start_changelog(changes, path, checkpoint, "update", state_partitions=state_partitions, state_store=ROCKSDB_PROVIDER, **trigger)


def with_message_key(alerts: DataFrame, settings: AlertSettings = DEFAULT) -> DataFrame:
    """Adds what names a message: ``key``, a hash of the window, the rule and the averages, and ``window_end``."""
    parts = [F.col("window.start"), F.col("window.end"), F.col("id"), F.col("code"), *[F.col(f"avg_{m}") for m in settings.measures]]
    text = F.to_json(F.struct(*[p.alias(f"c{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"})
    return alerts.withColumns({"key": F.sha2(text, 256), "window_end": F.col("window.end")})


def start_publish_once(
    alerts: DataFrame,
    to_messages: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    settings: AlertSettings = DEFAULT,
    after_write: Callable[[int], None] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Publish each alert's message once, to ``path/messages/batch_id=<n>``; ``path/ledger`` holds the keys of all batches.

    A batch first leaves out keys that the ledger has from other batches, then
    replaces its own output folder, then its ledger folder. If it fails in
    between (``after_write`` stands for that in tests), its replay writes the
    same rows to the same folder; if the checkpoint is lost and old input comes
    again under new batch numbers, the ledger knows its keys. Only ledger rows
    of windows that the batch has are read (``window_end`` prunes the files).
    """
    spark = alerts.sparkSession
    ledger_schema = "key string, window_end timestamp, batch_id int"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        keyed = with_message_key(batch, settings).dropDuplicates(["key"])
        span = keyed.agg(F.min("window_end").alias("lo"), F.max("window_end").alias("hi")).first()
        number = _publication(spark, f"{path}/ledger", batch_id, checkpoint)
        if span["lo"] is None:
            return
        known = spark.read.schema(ledger_schema).parquet(f"{path}/ledger") if _exists(spark, f"{path}/ledger") else None
        fresh = keyed
        if known is not None:
            others = known.where((F.col("batch_id") != number) & F.col("window_end").between(span["lo"], span["hi"]))
            fresh = keyed.join(others.select("key"), "key", "left_anti")
        out = f"{path}/messages/{CHANGELOG_COLUMN}={number}"
        to_messages(fresh).write.mode("overwrite").parquet(out)
        if after_write is not None:
            after_write(batch_id)
        fresh.select("key", "window_end").write.mode("overwrite").parquet(f"{path}/ledger/batch_id={number}")

    writer = alerts.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(alerts, _trigger(writer, available_now, processing_time), state_partitions)


def _exists(spark, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _publication(spark, ledger: str, batch_id: int, checkpoint: str) -> int:
    """The folder number of a batch: batch numbers start anew with a new checkpoint, so each checkpoint has a range of its own."""
    origin = f"{ledger}-origins"
    known = {r[0]: r[1] for r in spark.read.schema("origin string, number int").json(origin).collect()} if _exists(spark, origin) else {}
    if checkpoint not in known:
        known[checkpoint] = len(known)
        spark.createDataFrame([(checkpoint, known[checkpoint])], "origin string, number int").coalesce(1).write.mode("append").json(origin)
    return known[checkpoint] * 100_000_000 + batch_id
