"""MinHash near-dedup with fast similarity sketches.

Method: a document is the set of its distinct five-word shingles. Its sketch
has T coordinates, filled in rounds: round i hashes every element to a bin and a
value, and a bin keeps the least (round, value). Rounds T to 2T send all
elements to bin i - T, so every coordinate fills; larger sets are full after a
few rounds. The share of equal coordinates is an unbiased, concentrated
estimate of the Jaccard similarity. Coordinates are banded (``BANDS`` of
``ROWS``), and documents that share a band's key are compared.

Links are exact: they are confirmed on the full sets (64-bit shingle hashes).
Not all pairs of a bucket are formed:

1. documents of equal sets are one node;
2. each node is confirmed against one representative, that of most of its
   buckets (the least node of the bucket), which gives first components;
3. in buckets that still hold several components, sketches are compared in
   blocks of bounded size, whatever the bucket's size; each pair of different
   components whose estimate is not far below the threshold is a candidate in
   the first band that it shares;
4. the nodes of candidates bring their full sets to the block, once each, and
   candidates are confirmed there from the most similar down, leaving out those
   that confirmed ones connect already. Only links leave the block.

What is missed: a pair at similarity 0.75 shares no band with probability
(1 - 0.75^4)^32 = 5e-6, or is estimated below ``LEAST_ESTIMATE`` (over 4.5
standard deviations down) with about 1e-6; both fall fast above 0.75.

Contract: words are split at ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; with
fewer than five words the whole sequence is one shingle; null or empty texts
have no shingle and are linked with nothing; repeated rows are of one node;
null ids count as the largest in a component; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (
    BROADCAST_KEYS, cut, join_counted, join_small, map_batches, materialize, only_kept, read_table, row_key, text_column,
)
from .components import components

SHINGLE = 5
#: Percent of the union that the intersection has at least.
SIMILAR = 75
COORDINATES, BANDS, ROWS = 256, 32, 4
LEAST_ESTIMATE = 0.62
#: Nodes of a bucket that are compared at once with as many others.
BLOCK = 512
MEMO_WORDS = 150_000

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hashes of words, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingle_set(text: bytes, hashes: dict) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + n]) * _A
        out ^= out >> np.uint64(29)
    return np.unique(_mix(out))


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches (sets, t) of non-empty sets; coordinates are (round, value) in one integer."""
    n = len(sets)
    out = np.full(n * t, _FULL, dtype=np.uint64)
    x = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    bits = np.uint64(t.bit_length() - 1)
    for i in range(2 * t):
        h = _mix(x + np.uint64((i + 1) * int(_A) & int(_FULL)))
        bin_ = (h & np.uint64(t - 1)).astype(np.int64) if i < t else i - t
        value = (np.uint64(i) << np.uint64(64 - 10)) | (h >> max(bits, np.uint64(10)))
        np.minimum.at(out, row * t + bin_, value)
        open_ = (out.reshape(n, t) == _FULL).any(axis=1)
        if not open_.any():
            break
        live = open_[row]
        if not live.all():
            x, row = x[live], row[live]
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of the first ``BANDS * ROWS`` coordinates."""
    parts = sketch[:, : BANDS * ROWS].reshape(len(sketch), BANDS, ROWS)
    key = np.zeros((len(sketch), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        key = _mix((key ^ parts[:, :, r]) * _A + np.uint64(r + 1))
    return key.view(np.int64)


def codes(sketch: np.ndarray) -> np.ndarray:
    """Eight bits of each coordinate, for estimates."""
    return (_mix(sketch) >> np.uint64(56)).astype(np.uint8)


_SIGNATURES = T.StructType(
    [
        T.StructField("_id", T.LongType()),
        T.StructField("_hash", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("codes", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: set size, a 128-bit digest of the set, sketch codes and band keys (null without words)."""
    key_id, key_hash = row_key(doc_id, text)
    source = docs.select(key_id.cast("long").alias("_id"), key_hash, text_column(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in cut(batches, "text"):
            if len(hashes) > MEMO_WORDS:
                hashes.clear()
            sets = [shingle_set(t, hashes) for t in batch.column("text").to_pylist()]
            digests = np.frombuffer(
                b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), dtype=np.int64
            ).reshape(-1, 2)
            some = [i for i, s in enumerate(sets) if len(s)]
            code: list = [None] * len(sets)
            key: list = [None] * len(sets)
            if some:
                sketch = sketches([sets[i] for i in some])
                for i, c, k in zip(some, codes(sketch), band_keys(sketch), strict=True):
                    code[i], key[i] = c.tobytes(), k
            columns = [batch.column("_id"), batch.column("_hash"), pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())]
            columns += [pa.array(code, pa.binary()), pa.array(key, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=_SIGNATURES.names)

    return map_batches(source, run, _SIGNATURES)


def shingle_sets(docs: DataFrame, wanted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The full sets (node, shingles) of the ``wanted`` nodes (node, _id, _hash of one of its documents)."""
    key_id, key_hash = row_key(doc_id, text)
    keyed = docs.select(key_id.cast("long").alias("_id"), key_hash, text_column(text).cast("binary").alias("text"))
    small = wanted.select("node", F.col("_id").alias("_i"), F.col("_hash").alias("_h"))
    if small.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        small = F.broadcast(small)
    texts = keyed.join(small, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in cut(batches, "text"):
            if len(hashes) > MEMO_WORDS:
                hashes.clear()
            sets = [shingle_set(t, hashes).view(np.int64) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), lists], names=["node", "shingles"])

    sets = map_batches(texts, run, "node long, shingles array<long>")
    return sets.groupBy("node").agg(F.first("shingles").alias("shingles"))  # repeated rows have one text


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. ``b`` should be the side without very frequent nodes."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"s_{name}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    both = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - both
    return joined.where(both * 100 >= union * SIMILAR).select("a", "b")


_GROUP = ["band", "key", "low", "high"]
_BLOCK_COLUMNS = [*_GROUP, "node", "label", "n", "part", "codes", "keys"]


def _candidates(g: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the candidate pairs in a block, and their numbers of equal coordinates."""
    least = int(np.ceil(LEAST_ESTIMATE * COORDINATES))
    first = g["part"] == g["low"][0]
    inside = g["low"][0] == g["high"][0]
    left, right = (np.arange(len(first)),) * 2 if inside else (np.flatnonzero(first), np.flatnonzero(~first))
    found = [np.zeros((3, 0), dtype=np.int64)]
    for i in range(0, len(left), 64):
        some = left[i : i + 64]
        ok = g["label"][some][:, None] != g["label"][right][None]
        if inside:
            ok &= some[:, None] < right[None]
        small, large = np.minimum(g["n"][some][:, None], g["n"][right]), np.maximum(g["n"][some][:, None], g["n"][right])
        x, y = np.nonzero(ok & (small * 100 >= large * SIMILAR))
        x, y = some[x], right[y]
        for k in range(0, len(x), 4096):
            p, q = x[k : k + 4096], y[k : k + 4096]
            same = (g["codes"][p] == g["codes"][q]).sum(axis=1)
            near = same >= least
            p, q, same = p[near], q[near], same[near]
            mine = (g["keys"][p] == g["keys"][q]).argmax(axis=1) == g["band"][0]
            found.append(np.stack([p[mine], q[mine], same[mine]]))
    return tuple(np.concatenate(found, axis=1))


def _blocks(batches: Iterator[pa.RecordBatch], sets: bool) -> Iterator[dict[str, np.ndarray]]:
    """The blocks of a sorted partition, one after the other."""

    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        get = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in _BLOCK_COLUMNS[:8]}
        get["codes"] = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        get["keys"] = np.array(batch.column("keys").flatten()).reshape(-1, BANDS)
        if sets:
            get["shingles"] = np.empty(batch.num_rows, dtype=object)
            get["shingles"][:] = [x.values.to_numpy() for x in batch.column("shingles")]
        return get

    held: dict[str, np.ndarray] | None = None
    for whole in batches:
        for start in range(0, whole.num_rows, 2 * BLOCK):
            now = arrays(whole.slice(start, 2 * BLOCK))
            if held is not None:
                now = {c: np.concatenate([held[c], now[c]]) for c in now}
            change = np.zeros(len(now["node"]) - 1, dtype=bool)
            for c in _GROUP:
                change |= now[c][1:] != now[c][:-1]
            starts = np.r_[0, np.flatnonzero(change) + 1]
            for i, j in zip(starts[:-1], starts[1:], strict=True):
                yield {c: v[i:j] for c, v in now.items()}
            held = {c: v[starts[-1] :] for c, v in now.items()}
    if held is not None:
        yield held


def candidate_rows(rows: DataFrame) -> DataFrame:
    """The rows of blocks that are in a candidate pair.

    ``rows``: band, key, size (of the bucket), node, label, n, codes, keys. A
    bucket of more than ``BLOCK`` nodes is cut into parts, and each two parts
    meet in a block of their own.
    """
    parts = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    rows = rows.select(*_BLOCK_COLUMNS).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _blocks(batches, sets=False):
            p, q, _ = _candidates(g)
            some = np.union1d(p, q)
            if len(some):
                columns = [pa.array(g[c][some]) for c in _BLOCK_COLUMNS[:8]]
                columns.append(pa.array([c.tobytes() for c in g["codes"][some]], pa.binary()))
                columns.append(pa.array(list(g["keys"][some]), pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=_BLOCK_COLUMNS)

    return map_batches(rows, run, rows.select(*_BLOCK_COLUMNS).schema)


def block_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what the candidates of each block connect, confirmed on the full sets."""
    rows = rows.join(sets, "node").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "node")

    def links(g: dict[str, np.ndarray]) -> list[tuple[int, int]]:
        p, q, same = _candidates(g)
        parent = {x: x for x in g["label"].tolist()}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for k in np.argsort(-same, kind="stable").tolist():
            i, j = int(p[k]), int(q[k])
            a, b = root(int(g["label"][i])), root(int(g["label"][j]))
            if a != b:
                x, y = g["shingles"][i], g["shingles"][j]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both * 100 >= (len(x) + len(y) - both) * SIMILAR:
                    parent[a] = b
                    out.append((int(g["node"][i]), int(g["node"][j])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _blocks(batches, sets=True):
            found = links(g)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return map_batches(rows.select(*_BLOCK_COLUMNS, "shingles"), run, "a long, b long")


def _open_rows(met: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows for :func:`candidate_rows`: the nodes of all buckets that hold more than one label."""
    labelled = met.select("band", "key", "node").join(labels, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    open_ = labelled.groupBy("band", "key").agg(
        F.count("*").alias("size"), F.min("label").alias("l"), F.max("label").alias("h")
    )
    open_ = materialize(open_.where("l <> h").select("band", "key", "size"), "near-open")
    rows = join_counted(labelled, open_, ["band", "key"], "size", max(1, met.count()))
    return rows.join(nodes.select("node", "n", "codes", "keys"), "node")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after further links (a, b) between nodes."""
    known = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    ends = links
    for side in ("a", "b"):
        ends = ends.join(known, F.col(side) == F.col("_n"), "left")
        ends = ends.withColumn(side, F.coalesce("_l", side)).drop("_n", "_l")
    again = components(ends).select(F.col("node").alias("label"), F.col("label").alias("to"))
    # nodes that had no link so far are their own label
    alone = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(alone.withColumn("label", F.col("node")))
    moved = join_small(every, again, ["label"]).select("node", F.coalesce("to", "label").alias("label"))
    return materialize(moved, "near-merged")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``n_shingles``, ``component_id``, ``kept``."""
    sig = materialize(signatures(docs, doc_id, text), "near-signatures")
    sets_of = sig.where("n > 0").groupBy("n", "d1", "d2").agg(
        F.min("_id").alias("least_id"),
        F.min(F.struct("_id", "_hash")).alias("member"),
        F.count("*").alias("size"),
        F.first("codes").alias("codes"),
        F.first("keys").alias("keys"),
    )
    nodes = materialize(sets_of.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    total = max(1, nodes.count() * BANDS)

    # buckets with two or more nodes
    banded = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("node").alias("least"), F.count("*").alias("size")).where("size > 1")
    buckets = materialize(buckets, "near-buckets")
    met = materialize(join_counted(banded, buckets, ["band", "key"], "size", total), "near-met")
    wanted = met.select("node").distinct().join(nodes.select("node", "member"), "node")
    wanted = materialize(wanted.select("node", "member.*"), "near-wanted")
    sets = materialize(shingle_sets(docs, wanted, doc_id, text), "near-sets")

    # one representative per node
    shared = met.where("node <> least").groupBy("node", "least").agg(F.count("*").alias("bands"))
    star = shared.groupBy("node").agg(F.max_by("least", F.struct("bands", -F.col("least"))).alias("a"))
    first = materialize(confirmed(star.select("a", F.col("node").alias("b")), sets), "near-links")
    labels = components(first)

    # buckets that hold several components
    rows = materialize(candidate_rows(_open_rows(met, nodes, labels)), "near-candidates")
    labels = _merged(labels, materialize(block_links(rows, sets), "near-links"))
    known = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    final = nodes.select("node", "n", "d1", "d2", "least_id", "size").join(known, F.col("node") == F.col("_n"), "left")
    final = final.withColumn("label", F.coalesce("_l", "node")).drop("_n", "_l")
    final = materialize(final, "near-labels")
    least = final.groupBy("label").agg(F.min("least_id").alias("component_id"), F.count("*").alias("members"))
    least = materialize(least, "near-components")
    placed = join_counted(final, least, ["label"], "members", max(1, final.count()))
    placed = materialize(placed.select("n", "d1", "d2", "size", "component_id"), "near-placed")

    some = sig.where("n > 0").select("_id", "_hash", "n", "d1", "d2")
    found = join_counted(some, placed, ["n", "d1", "d2"], "size", max(1, some.count())).select("_id", "_hash", "n", "component_id")
    none = sig.where("n = 0").select("_id", "_hash", "n", F.col("_id").alias("component_id"))
    kept = F.col("_id").eqNullSafe(F.col("component_id"))
    return found.unionByName(none).select("_id", "_hash", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one of the smallest id, with its columns unchanged."""
    return only_kept(docs, near_duplicates(docs, doc_id, text).select("_id", "_hash", "kept"), doc_id, text)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``documents``."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", "kept")
