"""Sinks for the streaming jobs.

* :func:`start_table` -- append-mode parquet table (Spark's file sink: its
  metadata log makes each micro-batch land exactly once).
* :func:`start_changelog` -- update (or append) mode through ``foreachBatch``:
  every micro-batch is written to its own ``batch_id=<n>`` folder, replacing a
  partial earlier attempt of the same batch, so a restarted batch is
  idempotent. :func:`latest_rows` reads the newest version of every key.
* :func:`start_kafka` -- the native Kafka sink on ``topic, value`` columns.
* :func:`start_console` -- printing, for a look at a running job.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.kafka import KafkaSettings


#: State store for large state: kept in RocksDB files beside the executor's heap.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STARTING = threading.Lock()


def _start(df: DataFrame, writer, state_partitions: int | None, state_store: str | None = None):
    """Start a query; ``state_partitions`` sets its shuffle/state partition count, ``state_store`` its provider.

    A stateful query fixes both at its first start (they are kept in the
    checkpoint). The query runs on its own copy of the session's settings,
    taken at start, so the session's are changed only around ``start``, by one
    query at a time.
    """
    own = {}
    if state_partitions:
        own["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store:
        own["spark.sql.streaming.stateStore.providerClass"] = state_store
    conf = df.sparkSession.conf
    with _STARTING:
        before = {k: conf.get(k, None) for k in own}
        for k, v in own.items():
            conf.set(k, v)
        try:
            return writer.start()
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)


def _trigger(writer, available_now: bool, processing_time: str | None):
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer


def start_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _start(df, _trigger(writer, available_now, processing_time), state_partitions, state_store)


CHANGELOG_COLUMN = "batch_id"


def start_changelog(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "update",
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
    compact_keys: Sequence[str] = (),
    compact_every: int = 100,
) -> StreamingQuery:
    """Write each micro-batch's output rows to ``<path>/batch_id=<n>``.

    With ``compact_keys`` every ``compact_every``-th batch is followed by a
    snapshot of the newest row per key (:func:`compact_changelog`) in
    ``<path>-snapshots``, which :func:`read_current` starts from.
    """
    schema = df.schema

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{CHANGELOG_COLUMN}={batch_id}")
        if compact_keys and batch_id % compact_every == 0:
            spark = df.sparkSession
            before = latest_snapshot(spark, f"{path}-snapshots")
            compact_changelog(spark, path, schema, compact_keys, f"{path}-snapshots", before)

    writer = df.writeStream.outputMode(output_mode).foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _start(df, _trigger(writer, available_now, processing_time), state_partitions, state_store)


def read_changelog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a changelog with their ``batch_id`` (INT)."""
    full = T.StructType(list(schema.fields) + [T.StructField(CHANGELOG_COLUMN, T.IntegerType(), True)])
    return spark.read.schema(full).parquet(path)


def latest_rows(changelog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the highest ``batch_id`` per key (the current state of an update-mode result).

    One aggregation with map-side partial ``max_by``; a key updated in many
    batches is reduced before the shuffle.
    """
    values = [c for c in changelog.columns if c not in keys and c != CHANGELOG_COLUMN]
    return changelog.groupBy(*keys).agg(*[F.max_by(c, CHANGELOG_COLUMN).alias(c) for c in values])


def compact_changelog(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], snapshot_root: str,
    snapshot: str | None = None,
) -> str:
    """Fold the changelog into a snapshot of the newest row per key; return its folder.

    The snapshot is written to a new folder ``<snapshot_root>/upto=<n>-<id>``
    (``n`` = highest batch folded in), never over an older one. Only batches
    whose write has ended (``_SUCCESS``) are folded, up to the first one that has
    not, so a batch that is being written stays for the next time. Passing the
    previous ``snapshot`` folds only the batches after it; without any it is
    returned as it is. Run it from time to time (a batch job next to the
    stream); the stream keeps appending batches meanwhile.
    """
    upto = committed_upto(spark, path)
    if upto is None:
        raise ValueError("the changelog has no finished batches yet")
    if snapshot is not None and _folded(snapshot) >= upto:
        return snapshot
    rows = current_rows(spark, path, schema, keys, snapshot, upto)
    out = f"{snapshot_root}/upto={upto}-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(out)
    return out


def committed_upto(spark: SparkSession, path: str) -> int | None:
    """The highest batch below the first one whose folder has no ``_SUCCESS`` marker (a few names per batch are listed)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    upto = None
    names = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    prefix = f"{CHANGELOG_COLUMN}="
    batches = {int(p.getName()[len(prefix) :]): p for p in names if p.getName().startswith(prefix)}
    for n in sorted(batches):
        if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(batches[n], "_SUCCESS")):
            break
        upto = n
    return upto


def latest_snapshot(spark: SparkSession, snapshot_root: str) -> str | None:
    """The finished snapshot that folds most batches, if there is one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(snapshot_root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    found = [p for p in found if p.getName().startswith("upto=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((p.toString() for p in found), key=_folded, default=None)


def read_current(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Newest row per key of a changelog that is compacted as it is written: its latest snapshot and the batches after it."""
    return current_rows(spark, path, schema, keys, latest_snapshot(spark, f"{path}-snapshots")).drop(CHANGELOG_COLUMN)


def _folded(snapshot: str) -> int:
    return int(snapshot.rstrip("/").rsplit("upto=", 1)[1].split("-")[0])


def current_rows(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], snapshot: str | None = None,
    upto: int | None = None,
) -> DataFrame:
    """Newest row per key, with its ``batch_id``: the snapshot plus the changelog batches after it.

    The filter on ``batch_id`` prunes the older batch folders, so the work
    follows the batches written since the snapshot, not the whole history.
    """
    log = read_changelog(spark, path, schema)
    if upto is not None:
        log = log.where(F.col(CHANGELOG_COLUMN) <= upto)
    if snapshot is not None:
        full = T.StructType(list(schema.fields) + [T.StructField(CHANGELOG_COLUMN, T.IntegerType(), True)])
        log = spark.read.schema(full).parquet(snapshot).unionByName(log.where(F.col(CHANGELOG_COLUMN) > _folded(snapshot)))
    values = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(*[F.max_by(c, CHANGELOG_COLUMN).alias(c) for c in values])


def start_kafka(
    messages: DataFrame,
    kafka: KafkaSettings,
    checkpoint: str,
    available_now: bool = False,
    processing_time: str | None = None,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Publish ``topic, value`` rows (each row names its own topic). Needs the Kafka connector jar."""
    writer = messages.writeStream.format("kafka").outputMode("append").options(**kafka.options())
    writer = writer.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _start(messages, _trigger(writer, available_now, processing_time), state_partitions)


def start_console(
    df: DataFrame,
    checkpoint: str,
    output_mode: str = "update",
    available_now: bool = True,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    writer = df.writeStream.format("console").outputMode(output_mode).option("truncate", "false")
    writer = writer.option("checkpointLocation", checkpoint)
    return _start(df, _trigger(writer, available_now, processing_time), state_partitions)
