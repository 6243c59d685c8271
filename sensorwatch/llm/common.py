"""Helpers shared by the operators of this subpackage.

Everything here is small plumbing around Spark: the shared work folder, typed
Arrow batches cut to a byte budget, joins with a table whose size is checked
first, and keys that hold a large share of all rows.
"""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: A broadcast side has at most this many rows (and the callers' rows are a few hundred bytes at most).
BROADCAST_ROWS = 20_000
#: A key with more than this share of all rows is hot: there are at most 1 / HOT_SHARE such keys.
HOT_SHARE = 1 / 200
#: Text handled at once in a Python worker.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._folder = path
    return written


def release(*tables: DataFrame) -> None:
    """Remove the folders of tables made by :func:`materialize` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def free_name(taken: Sequence[str], base: str) -> str:
    """A column name that no column of ``taken`` has (Spark's names ignore case)."""
    have = {c.lower() for c in taken}
    name, k = base, 0
    while name.lower() in have:
        k += 1
        name = f"{base}_{k}"
    return name


def quoted(name: str) -> Column:
    """A top-level column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def join_small(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", salts: int = 64) -> DataFrame:
    """Join with a table of one row per key, null-safe on the keys.

    ``small`` (written already) is counted: up to ``BROADCAST_ROWS`` rows it is
    broadcast; beyond that the keys are salted, so a key with a third of all
    rows of ``big`` still spreads over ``salts`` tasks.
    """
    small = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    cond = [big[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    drop = [f"_k_{k}" for k in keys]
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), cond, how).drop(*drop)
    big = big.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
    small = small.withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cond = [big[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_salt") == F.col("_salt2")]
    return big.join(small, cond, how).drop("_salt", "_salt2", *drop)


def join_counted(big: DataFrame, groups: DataFrame, keys: Sequence[str], count: str, total: int) -> DataFrame:
    """Inner join on non-null keys with one row per key that knows its number of rows in ``big``.

    Keys with more than ``HOT_SHARE`` of the ``total`` rows (at most
    ``1 / HOT_SHARE`` of them) are broadcast; the others shuffle, none of them
    larger than that share. ``groups`` is written already.
    """
    limit = max(1, int(total * HOT_SHARE))
    hot = groups.where(F.col(count) > limit)
    cold = groups.where(F.col(count) <= limit)
    if not hot.limit(1).count():
        return big.join(cold, list(keys))
    hot_keys = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    rest = big.join(F.broadcast(hot_keys), [big[k] == F.col(f"_h_{k}") for k in keys], "left_anti")
    return big.join(F.broadcast(hot), list(keys)).unionByName(rest.join(cold, list(keys)))


def process_memo(name: str) -> dict:
    """A dict that lives as long as the Python worker process, which serves many tasks."""
    module = sys.modules.setdefault("_sensorwatch_process_memo", types.ModuleType("_sensorwatch_process_memo"))
    return module.__dict__.setdefault(name, {})


def forget_memos(but: str | None) -> None:
    """Drop what operators other than ``but`` left in this worker process."""
    module = sys.modules.get("_sensorwatch_process_memo")
    for name in [n for n, v in vars(module).items() if isinstance(v, dict) and n != but] if module else []:
        if not name.startswith("__"):
            delattr(module, name)


def give_back_memory() -> None:
    """Return free memory to the system: worker processes outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


class _Both(dict):
    """Entries of this batch, and behind them the remembered ones."""

    def __init__(self, found: dict, memo: dict):
        super().__init__(found)
        self.memo = memo

    def __missing__(self, key):
        return self.memo[key]


def remember(memo: dict, found: dict, most: int) -> dict:
    """Add ``found`` to ``memo`` as far as ``most`` entries go; a mapping that has all of both."""
    room = most - len(memo)
    if room >= len(found):
        memo.update(found)
        return memo
    if room > 0:
        memo.update(islice(found.items(), room))
    return _Both(found, memo)


def cut(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``max_bytes`` in a string or binary column, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()  # worker processes outlive their tasks


#: Limits of an Arrow batch between Spark and a Python worker; texts can be long.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def map_batches(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema,
    memo: str | None = None,
) -> DataFrame:
    """``mapInArrow`` with small batches: the session's limits are lowered to ours if they are higher.

    They are read when the query runs, so they stay as they are set here. A
    task first drops the :func:`process_memo` of operators other than ``memo``
    and at its end returns the memory it no longer uses.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_memos(memo)
        try:
            yield from fn(batches)
        finally:
            give_back_memory()

    conf = df.sparkSession.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == "67108864b":  # Spark's default
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def text_column(name: str = "text") -> Column:
    """The whole text, null as empty."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


#: Keys of two integers up to this many are broadcast (about 30 MB in memory); more are joined by shuffle.
BROADCAST_KEYS = 500_000


def row_key(doc_id: str, text: str) -> list[Column]:
    """What tells rows apart: the id and a 64-bit hash of the text. Rows equal in both are repeats of one document."""
    return [quoted(doc_id).alias("_id"), F.xxhash64(text_column(text)).alias("_hash")]


def only_kept(docs: DataFrame, verdicts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` (``_id``, ``_hash``, ``kept``; one row per document) keeps.

    Of rows repeated with their id and text just one stays. Only the keys of
    dropped and of repeated rows are joined, texts are shuffled only beyond
    ``BROADCAST_KEYS`` of them.
    """
    names = free_name(docs.columns, "_id"), free_name(docs.columns, "_hash")
    keys = verdicts.groupBy("_id", "_hash").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    keys = materialize(keys.where(~F.col("kept") | (F.col("n") > 1)), "kept-keys")
    keyed = docs.withColumns(dict(zip(names, row_key(doc_id, text), strict=True)))

    def side(some: DataFrame) -> tuple[DataFrame, Column]:
        small = some.select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"))
        if small.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
            small = F.broadcast(small)
        return small, quoted(names[0]).eqNullSafe(F.col("_i")) & (quoted(names[1]) == F.col("_h"))

    stay = keyed.join(*side(keys.where(~F.col("kept"))), "left_anti")
    repeated = keys.where("kept")
    if repeated.limit(1).count():
        once = stay.join(*side(repeated), "left_semi").dropDuplicates(list(names))
        stay = stay.join(*side(repeated), "left_anti").unionByName(once)
    return stay.select(*map(quoted, docs.columns))
