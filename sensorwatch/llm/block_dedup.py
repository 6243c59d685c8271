"""Exact dedup by deterministic block naming.

Method: a normalised text is cut into fixed-size blocks. Equal blocks get one
integer name: blocks are brought together by value, sorted, and named by the
position of their first one in sort order. Then adjacent names of a document
are paired and the pairs named in the same way, until every document has one
name. Names stand for values, never for hashes, so two documents of the same
number of blocks have the same last name exactly if their texts are equal.

Hot values (a block or pair with a large share of all rows) would meet in one
task. They are found by counting 64-bit hashes (partial sums; at most
``1 / HOT_SHARE`` of them), named apart, and joined by broadcast; the values
themselves are compared there too. Each level's names are written to the shared
folder, so later levels read three integers a row. Only DataFrame operations.

Contract: texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``;
null counts as empty, and all empty texts are equal. The row with the most code
points in the original text, then the smallest ``doc_id`` (null first), then
any one row of repeated rows stays. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import HOT_SHARE, free_name, join_counted, materialize, only_kept, quoted, read_table, row_key, text_column

#: Code points in a block.
BLOCK = 4096
_SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), _SPACES, text)


def name_values(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with an integer ``name`` in place of ``keys``: equal for equal keys, different for different ones.

    Names of hot values are negative, all others are 0 and more.
    """
    others = [c for c in rows.columns if c not in keys]
    limit = max(1, int(total * HOT_SHARE))
    digest = F.xxhash64(*keys)
    counts = rows.groupBy(digest.alias("_h")).agg(F.count("*").alias("_n"))
    # at most 1 / HOT_SHARE numbers
    hot = [r[0] for r in counts.where(F.col("_n") > limit).select("_h").collect()]
    is_hot = digest.isin(hot) if hot else F.lit(False)
    cold = rows.where(~is_hot).repartition(*keys).sortWithinPartitions(*keys)
    cold = cold.withColumn("_at", F.monotonically_increasing_id())
    cold = cold.select(*others, F.min("_at").over(Window.partitionBy(*keys)).alias("name"))
    if not hot:
        return cold
    values = rows.where(is_hot).select(*keys).distinct()  # as many as the hot hashes, but for collisions
    names = values.select(*keys, (-1 - F.row_number().over(Window.orderBy(*keys))).cast("long").alias("name"))
    return cold.unionByName(rows.where(is_hot).join(F.broadcast(names), keys).select(*others, "name"))


def identities(docs: DataFrame, text: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: the ``carry`` columns, ``blocks`` (their number) and ``name``, its identity.

    ``row`` numbers the documents. The text itself is read, cut and shuffled once (hot blocks aside) and not written.
    """
    carry = carry or {}
    norm = free_name([*docs.columns, *carry], "_norm")
    numbered = docs.select("*", normalised(text_column(text)).alias(norm)).select(
        F.struct(*[c.alias(n) for n, c in {"row": F.monotonically_increasing_id(), **carry}.items()]).alias("doc"),
        F.col(norm).alias("norm"),
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.length("norm") / F.lit(BLOCK))).cast("int")
    cut = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.substring("norm", i * BLOCK + 1, F.lit(BLOCK)))
    rows = numbered.select("doc", blocks.alias("blocks"), F.posexplode(cut).alias("pos", "block"))
    # what goes with a document stays on its first block
    rows = rows.select(
        F.col("doc.row").alias("row"), F.when(F.col("pos") == 0, F.col("doc")).alias("doc"), "blocks", "pos", "block"
    )
    size = rows.agg(F.count("*").alias("n"), F.max("blocks").alias("most")).first()
    named = materialize(name_values(rows, ["block"], size["n"]), "dedup-names")
    done, left, most = [named.where("blocks = 1")], named.where("blocks > 1"), size["most"] or 1
    span = 1
    while span < most:
        span *= 2
        pairs = left.groupBy("row", (F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max("doc").alias("doc"),
            F.first("blocks").alias("blocks"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"),
        )
        # the end of an odd sequence has no right neighbour: a value of its own, which no name has
        pairs = pairs.withColumn("b", F.coalesce("b", F.lit(-(1 << 62))))
        pairs = materialize(pairs, "dedup-pairs")
        named = materialize(name_values(pairs, ["a", "b"], max(1, pairs.count())), "dedup-names")
        done.append(named.where(F.col("blocks") <= span))
        left = named.where(F.col("blocks") > span)
    whole = reduce(DataFrame.unionByName, done)
    return whole.select("doc.*", "blocks", "name")


def groups(ids: DataFrame) -> DataFrame:
    """Adds the members' number ``group_size`` and the one that stays (``keep``: its id and row) to each document.

    ``ids`` has ``row``, ``doc_id``, ``points`` (code points of the original text), ``blocks`` and ``name``.
    """
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id"), F.col("row"))).alias("keep")
    found = materialize(ids.groupBy("blocks", "name").agg(F.count("*").alias("group_size"), best), "dedup-groups")
    return join_counted(ids, found, ["blocks", "name"], "group_size", max(1, ids.count()))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: ``row``, ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and the ``extra`` columns."""
    extra = extra or {}
    carry = {"doc_id": quoted(doc_id), "points": F.length(text_column(text)), **extra}
    ids = materialize(identities(docs, text, carry), "dedup-ids")
    return groups(ids).select(
        "row",
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        *extra,
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their columns unchanged."""
    key = dict(zip(["_id", "_hash"], row_key(doc_id, text), strict=True))
    return only_kept(docs, dedup(docs, doc_id, text, key).select("_id", "_hash", "kept"), doc_id, text)


def op4_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    digest = F.sha2(normalised(text_column()).cast("binary"), 256)
    found = dedup(docs, extra={"text_sha256": digest})
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[ \\t-\\r]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
"""
