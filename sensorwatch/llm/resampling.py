"""Importance resampling of documents towards the word statistics of a target set.

Method: every document's features (runs of one and two words) are counted in
10,000 hashed buckets, and the counts are kept as bit planes: bit ``b`` of plane
``i`` is bit ``i`` of bucket ``b``'s count. Corpus counts come from adding
planes with bitwise full adders. The log-ratio gains of the buckets become
signed bit planes too (two's complement), and a document's exact total gain is
a sum of ``+-2^(i+j) * popcount(count plane i AND gain plane j)``. Scores add
Gumbel noise from a hash of the id, so the highest scores are a weighted sample
without replacement; ranks come from a range sort and per-file offsets.

Contract: null text has no words; a document without features has weight 0; a
null id is hashed as the empty text and ranks behind equal scores; rows repeated
with their id count and are ranked row by row; empty tables (documents, target
or both) give gains from the smoothing alone; only the id and text are read,
other columns play no part. Words, counts and planes cover whole texts.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import BROADCAST_ROWS, cut, map_batches, materialize, quoted, read_table, text_column

BUCKETS = 10_000
#: Words of 64 bits in a plane.
PLANE = -(-BUCKETS // 64)
#: Words of up to this many bytes are hashed together, longer ones singly.
LONG_WORD = 64
#: Noise of a document: a hash of this and its id.
SEED = "7:"
MIN_WORDS, DRAW_PERCENT = 20, 25


def crc_table() -> np.ndarray:
    """The 256 steps of CRC-32 (polynomial 0xEDB88320, reflected)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1).astype(np.uint32)
    return c


def shift_tables(table: np.ndarray) -> np.ndarray:
    """``[n, k, b]``: what byte ``b`` at place ``k`` of a checksum becomes when ``n`` bytes follow."""
    out = np.empty((LONG_WORD + 2, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, len(out)):
        out[n] = table[out[n - 1] & 255] ^ (out[n - 1] >> 8)
    return out


class FeatureBuckets:
    """Buckets of the features of texts: all words of a batch are hashed position by position."""

    def __init__(self) -> None:
        self.table = crc_table()
        self.shift = shift_tables(self.table)
        self.lower = np.zeros(256, dtype=np.uint8)  # 0: not part of a word
        for b in range(256):
            if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
                self.lower[b] = b
            elif 0x41 <= b <= 0x5A:
                self.lower[b] = b + 32
        space = np.uint32(zlib.crc32(b" "))
        self.after_space = self._moved(np.arange(LONG_WORD + 1), np.full(LONG_WORD + 1, space))

    def _moved(self, n: np.ndarray, crc: np.ndarray) -> np.ndarray:
        """Checksums as they enter that of a longer text, ``n`` more bytes behind."""
        s = self.shift
        return s[n, 0, crc & 255] ^ s[n, 1, (crc >> 8) & 255] ^ s[n, 2, (crc >> 16) & 255] ^ s[n, 3, crc >> 24]

    def _word_crcs(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        crc = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
        order = np.argsort(-sizes, kind="stable")
        ordered = sizes[order]
        at, state = starts[order], crc[order]
        for p in range(min(LONG_WORD, int(ordered[0])) if len(ordered) else 0):
            n = int(np.searchsorted(-ordered, -p, side="left"))  # words longer than p
            part = state[:n]
            state[:n] = self.table[(part ^ data[at[:n] + p]) & 255] ^ (part >> 8)
        crc[order] = ~state
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            crc[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]])
        return crc

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per text, and the text and bucket of each feature; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""
        data = self.lower[data]
        inside = data != 0
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        before = np.r_[False, inside[:-1]] if len(inside) else inside
        starts = np.flatnonzero(inside & (first[:-1] | ~before))
        behind = np.r_[inside[1:], False] if len(inside) else inside
        ends = np.flatnonzero(inside & (first[1:] | ~behind)) + 1
        sizes = ends - starts
        doc = np.searchsorted(offsets, starts, side="right") - 1
        crc = self._word_crcs(data, starts, sizes)
        left = np.flatnonzero(doc[1:] == doc[:-1])
        right = left + 1
        n = np.minimum(sizes[right], LONG_WORD)
        pairs = self._moved(n + 1, crc[left]) ^ self.after_space[n] ^ crc[right]
        for k in np.flatnonzero(sizes[right] > LONG_WORD).tolist():
            i = right[k]
            pairs[k] = zlib.crc32(data[starts[i] : ends[i]], zlib.crc32(b" ", int(crc[left[k]])))
        buckets = np.concatenate([crc, pairs]) % BUCKETS
        return np.bincount(doc, minlength=len(offsets) - 1), np.concatenate([doc, doc[left]]), buckets.astype(np.int64)


def to_planes(n_docs: int, doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of each document's bucket counts, documents one behind the other, and planes per document."""
    keys, counts = np.unique(doc * BUCKETS + bucket, return_counts=True)
    doc, bucket = keys // BUCKETS, keys % BUCKETS
    most = np.zeros(n_docs, dtype=np.int64)
    np.maximum.at(most, doc, counts)
    n = np.ceil(np.log2(most + 1)).astype(np.int64)  # exact below 2^48
    first = np.cumsum(n) - n
    planes = np.zeros(int(n.sum()) * PLANE * 8, dtype=np.uint8)
    for i in range(int(n.max(initial=0))):
        has = np.flatnonzero((counts >> i) & 1)
        at = (first[doc[has]] + i) * (PLANE * 8) + (bucket[has] >> 3)
        np.add.at(planes, at, (1 << (bucket[has] & 7)).astype(np.uint8))  # distinct bits: adding sets them
    return planes, n


def add_planes(by_bit: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """One plane per bit from any number of rows per bit: the sum of all counts, by bitwise full adders."""
    out, bit = {}, 0
    rows = dict(by_bit)
    while rows and bit <= max(rows):
        x = rows.pop(bit, None)
        while x is not None and len(x) > 1:
            m = max(1, len(x) // 3)
            if len(x) == 2:
                total, carry, rest = x[:1] ^ x[1:], x[:1] & x[1:], x[2:]
            else:
                a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
                odd = a ^ b
                total, carry, rest = odd ^ c, (a & b) | (c & odd), x[3 * m :]
            x = np.concatenate([total, rest])
            if carry.any():
                rows[bit + 1] = np.concatenate([rows[bit + 1], carry]) if bit + 1 in rows else carry
        if x is not None:
            out[bit] = x
        bit += 1
    return out


def _plane_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The batch's planes as rows of 64-bit words, the bit each row stands for, and planes per document."""
    column = batch.column("planes")
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(-1, PLANE)
    n = pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // (PLANE * 8)
    bit = np.arange(len(raw)) - np.repeat(np.cumsum(n) - n, n)
    return raw, bit, n


def count_planes(docs: DataFrame, doc_id: str | None = "doc_id", text: str = "text") -> DataFrame:
    """``id`` (as it is), ``key`` (its text), ``n_words``, ``n_features`` and the bit planes of each document."""
    given = quoted(doc_id) if doc_id else F.lit(None).cast("long")
    source = docs.select(given.alias("id"), given.cast("string").alias("key"), text_column(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = FeatureBuckets()
        for batch in cut(batches, "text"):
            column = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
            n_words, doc, bucket = buckets.features(data, offsets - offsets[0])
            planes, n = to_planes(len(column), doc, bucket)
            ends = np.r_[0, np.cumsum(n)] * (PLANE * 8)
            view = planes.tobytes()
            packed = [view[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [
                batch.column("id"),
                batch.column("key"),
                pa.array(n_words.astype(np.int64)),
                pa.array((n_words + np.maximum(n_words - 1, 0)).astype(np.int64)),
                pa.array(packed, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "n_words", "n_features", "planes"])

    return map_batches(source, run, f"id {kind}, key string, n_words long, n_features long, planes binary")


def bucket_counts(planes: DataFrame) -> DataFrame:
    """Corpus counts ``bucket, n``: planes are added within a task, and the tasks' counts by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, bit, _ = _plane_rows(batch)
            new = {i: rows[bit == i] for i in range(int(bit.max(initial=-1)) + 1)}
            both = new.keys() | total.keys()
            total = add_planes({i: np.concatenate([x[i] for x in (total, new) if i in x]) for i in both})
        counts = np.zeros(PLANE * 64, dtype=np.int64)
        for i, plane in total.items():
            counts += np.unpackbits(plane.view(np.uint8), bitorder="little").astype(np.int64) << i
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["bucket", "n"])

    per_task = map_batches(planes.select("planes"), run, "bucket int, n long")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(counts: DataFrame, target: DataFrame) -> list[int]:
    """The gain of every bucket (10,000 numbers, whatever the corpus)."""
    s, t = [0] * BUCKETS, [0] * BUCKETS
    for into, table in ((s, counts), (t, target)):
        for row in table.collect():
            into[row["bucket"]] = row["n"]
    all_s, all_t = sum(s), sum(t)
    return [
        math.floor(1000 * math.log(float((t[b] + 1) * (all_s + BUCKETS)) / float((s[b] + 1) * (all_t + BUCKETS))))
        for b in range(BUCKETS)
    ]


def gain_planes(gains: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the gains in two's complement and what each is worth; the last one is the sign's."""
    g = np.zeros(PLANE * 64, dtype=np.int64)
    g[: len(gains)] = gains
    bits = max(int(g.max()).bit_length(), int(-g.min() - 1).bit_length() if g.min() < 0 else 0) + 1
    rows = [np.packbits((g >> j) & 1 == 1, bitorder="little").view("<u8") for j in range(bits)]
    worth = np.array([1 << j for j in range(bits - 1)] + [-(1 << (bits - 1))], dtype=np.int64)
    return np.stack(rows), worth


def noise(key: str | None) -> float:
    """Gumbel noise of a document, from its id alone."""
    h = int(hashlib.sha256((SEED + (key or "")).encode()).hexdigest()[:8], 16)
    return -1000 * math.log(-math.log((h + 0.5) / 4294967296))


def score_documents(planes: DataFrame, gains: list[int]) -> DataFrame:
    """``id``, ``n_words``, ``n_features``, ``weight`` (floored mean gain) and ``score`` of each document."""
    kind = planes.schema["id"].dataType.simpleString()
    g, worth = gain_planes(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, bit, n = _plane_rows(batch)
            sums = np.zeros(len(rows), dtype=np.int64)
            for plane, value in zip(g, worth.tolist(), strict=True):
                sums += np.bitwise_count(rows & plane).sum(axis=1, dtype=np.int64) * value
            upto = np.r_[0, np.cumsum(sums << bit)]
            ends = np.cumsum(n)
            total = upto[ends] - upto[ends - n]
            features = batch.column("n_features").to_numpy(zero_copy_only=False)
            weight = total // np.maximum(features, 1)  # floors, below zero too
            score = weight + np.array([math.floor(noise(k)) for k in batch.column("key").to_pylist()], dtype=np.int64)
            columns = [*(batch.column(c) for c in ("id", "n_words", "n_features")), pa.array(weight), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "weight", "score"])

    return map_batches(planes, run, f"id {kind}, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame) -> DataFrame:
    """Adds ``rank``, 1 for the highest score, equal scores by ascending id: a range sort, then an offset per file.

    ``scored`` is written already, so its row numbers (which only spread
    repeated rows over the sort's partitions) stay the same.
    """
    tie = F.monotonically_increasing_id().alias("_tie")
    keys = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("_tie")]
    ordered = scored.select("*", tie).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "resampling-order")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    # one row per partition of the sort
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    if sizes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    joined = placed.withColumn("_part", part).join(offsets, "_part")
    return joined.withColumn("rank", F.col("_before") + inside + 1).drop("_part", "_place", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = DRAW_PERCENT,
    min_words: int = MIN_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``id, n_words, n_features, weight, score, rank`` of every document; ``rank`` is null where it is not drawn.

    Of the ``N`` documents with at least ``min_words`` words the
    ``floor(percent * N / 100)`` of the highest scores are drawn.
    """
    planes = materialize(count_planes(docs, doc_id, text), "resampling-planes")
    gains = bucket_gains(bucket_counts(planes), bucket_counts(count_planes(target, None, target_text)))
    scored = materialize(score_documents(planes, gains), "resampling-scores")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked(able).withColumn("rank", rank).unionByName(rest)


def drawn_documents(docs: DataFrame, result: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents drawn in ``result`` (ids without repeats), with all their columns."""
    ids = result.where(F.col("rank").isNotNull()).select(F.col("id").alias("_drawn")).distinct()
    return docs.join(ids, quoted(doc_id).eqNullSafe(F.col("_drawn")), "left_semi")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, scores and draw of all ``documents`` towards ``benchmark``."""
    out = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_FEATURES = "unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])"
_BYTES = (
    "[(instr('0123456789abcdef', x[1]) - 1) * 16 + instr('0123456789abcdef', x[2]) - 1"
    " FOR x IN regexp_extract_all(lower(hex(encode(f))), '..')]"
)

OP12_SQL = f"""
WITH crc AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(b))
),
docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT {_WORDS} AS w FROM benchmark),
doc_features AS MATERIALIZED (SELECT row, f, count(*) AS n FROM (SELECT row, {_FEATURES} AS f FROM docs) GROUP BY row, f),
item_features AS MATERIALIZED (SELECT f, count(*) AS n FROM (SELECT {_FEATURES} AS f FROM items) GROUP BY f),
buckets AS MATERIALIZED (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || {_BYTES}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT f FROM doc_features UNION SELECT f FROM item_features), crc
),
s AS (SELECT bucket, sum(n) AS n FROM doc_features JOIN buckets USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM item_features JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS all_s, coalesce((SELECT sum(n) FROM t), 0) AS all_t),
gains AS (
  SELECT s.bucket, floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((s.n + 1) * (all_t + 10000) AS DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), totals
),
sums AS (SELECT row, sum(n * gain) AS total, sum(n) AS n_features FROM doc_features JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY row),
weighed AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM docs LEFT JOIN sums USING (row)
),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
places AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank
FROM places
"""
