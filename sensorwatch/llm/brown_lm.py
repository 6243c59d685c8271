"""LM scoring with Brown class-based bigrams.

Method: exchange clustering moves words between classes as long as the class
bigram likelihood of the training text grows; a word's probability is that of
its class after the class before, times its own within its class, mixed with
the word's overall frequency.

Over the corpus, in Spark:

1. texts are read in blocks of bounded size; a block's words get local numbers,
   its documents become number sequences, its dictionary carries training counts;
2. words live at homes (a quarter of the blocks, more if these are few), which add up exact corpus
   counts for every word and know the blocks that have it. The blocks get the
   counts back once and number their words anew, by home and place there, so
   that later just classes and counts travel, in that order;
3. words seen ``RARE`` times and more have classes of their own, all rarer ones
   share a class (1), which is also that of words never seen; class 0 is the
   end token's alone. The number of classes grows with the vocabulary
   (:func:`class_count`);
4. a start: the ``OWN`` most frequent words are moved one after the other with
   exact likelihood changes, from counts summed in one pass a sweep, while all
   others are in class 1;
5. sweeps over all words with classes, the others starting spread over all classes
   (words that are all in one have no reason to part): the homes send the classes to the blocks,
   these sum per word the classes of its left and right neighbours, the homes
   add them up. Then words outside the most frequent ones move at their homes, by
   exact likelihood changes against the table of class bigrams, in small groups
   after each of which a home's copy of the table follows, as if all homes had
   moved alike; the ``OWN`` most frequent ones move on the driver as before. A
   sweep that does not raise the likelihood is undone and tried with a quarter of
   the words; the sweeps end when one raises it by no more than ``RISE`` nats a token
   and by no more than the one before;
6. a tenth of the training documents (crc32 of the id modulo 10 is 1) takes no
   part in the clustering: for each class, the weight of the class model against
   the word's overall frequency is what makes these documents most probable. Both
   models then count all training documents;
7. a last pass scores all documents.

Each sweep's table replaces the one before, whose folder is removed.

Contract: null text counts as empty (just the end token); a null id counts as
the empty text for the held-out rule; repeated rows are documents of their own;
an empty table gives an empty result; with no training document every word is
unknown; only the id and text columns are read, whatever other columns are
called.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_batches, materialize, quoted, read_table, release, text_column

#: Words moved one by one on the driver; occurrences from which a word has a class of its own.
OWN, RARE = 2047, 3
#: A sweep counts as a rise if it gains more than this a training token (nats); share of the words that move at the least.
RISE, LEAST_SHARE = 1e-2, 1 / 16
#: Few blocks have that many homes of words each, up to ``LEAST_HOMES`` in all, many share one: a home's work and its bytes to
#: and from each block cost little beside what each call costs only if it has many words.
HOMES, LEAST_HOMES, BLOCKS_A_HOME = 4, 16, 4
#: Words are weighed at once up to this many entries and this share of a home's tokens.
MOVE_ENTRIES, MOVE_SHARE = 20_000, 1 / 64
#: A block ends at this many words or distinct words.
BLOCK_WORDS, BLOCK_DISTINCT = 1_500_000, 250_000
ADD = 0.1
#: Weights of the class model that are tried.
WEIGHTS = np.arange(100) / 100

_BLOCKS = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("fold", T.IntegerType()),  # 0: held out, 1: weights of the models
        T.StructField("sequence", T.BinaryType()),  # local word numbers, uint32
        T.StructField("words", T.ArrayType(T.BinaryType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ]
)
_SEQUENCES = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("log_counts", T.DoubleType()),  # sum of log10(count + ADD) over the words
        T.StructField("sequence", T.BinaryType()),  # numbers of classed words from 1, 0 for all others, uint32
        T.StructField("buckets", T.BinaryType()),  # uint16, the end token's 0 last
    ]
)


def class_count(n_words: int) -> int:
    """Classes for so many words with classes: 16 for 4,000 words, 32 for 260,000, 64 for 17 million; 128 at the most."""
    return int(min(128, max(4, round(4 * n_words ** (1 / 6)))))


def fold(doc_id: str = "doc_id") -> Column:
    text = F.coalesce(quoted(doc_id).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % 10).cast("int")


def words_of(text: bytes) -> list[bytes]:
    """Lower-case A-Z, split at ``[\\x20\\x09-\\x0D]+``: just what bytes.lower and bytes.split do."""
    return text.lower().split()


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents as local number sequences, and a dictionary row per block."""
    source = docs.select(
        quoted(doc_id).cast("long").alias("doc_id"), fold(doc_id).alias("fold"), text_column(text).cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        numbers: dict[bytes, int] = defaultdict(count().__next__)  # a new word takes the next number
        rows: list[tuple] = []
        seen: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            block = (part << 24) | number
            known = np.concatenate(seen) if seen else np.zeros(0, dtype=np.uint32)
            counts = np.bincount(known, minlength=len(numbers))
            n = len(rows)
            columns = [
                pa.array([block] * (n + 1), pa.int64()),
                pa.array([r[0] for r in rows] + [None], pa.int64()),
                pa.array([r[1] for r in rows] + [None], pa.int32()),
                pa.array([r[2] for r in rows] + [None], pa.binary()),
                pa.array([None] * n + [list(numbers)], pa.list_(pa.binary())),
                pa.array([None] * n + [counts.tolist()], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=_BLOCKS.names)

        for batch in cut(batches, "text"):
            triples = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "fold", "text")), strict=True)
            for i, part_of, data in triples:
                words = words_of(data)
                ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.uint32, count=len(words))
                rows.append((i, part_of, ids.tobytes()))
                if part_of:
                    seen.append(ids)
                total += len(words) + 1
                if total >= BLOCK_WORDS or len(numbers) >= BLOCK_DISTINCT:
                    yield flush()
                    number, total = number + 1, 0
                    numbers, rows, seen = defaultdict(count().__next__), [], []
        if rows:
            yield flush()

    return map_batches(source, run, _BLOCKS)


_ROUTES = "array<struct<block: bigint, numbers: binary, counts: binary, places: binary>>"
_HOMES = f"home int, words array<binary>, totals binary, routes {_ROUTES}"


def _squeeze(values: np.ndarray, dtype, rising: bool = False) -> bytes:
    """Packed numbers, as narrow as they are; of ``rising`` ones the differences."""
    values = np.asarray(values).astype(dtype)
    values = np.diff(values, prepend=values.dtype.type(0)) if rising else values
    if values.itemsize > 1 and len(values) and values.min() >= 0:
        values = values.astype(np.min_scalar_type(values.max()))
    data = values.tobytes()
    return bytes([values.itemsize]) + len(data).to_bytes(7, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _loosen(data: bytes, dtype, rising: bool = False) -> np.ndarray:
    width, size, dtype = data[0], int.from_bytes(data[1:8], "little"), np.dtype(dtype)
    out = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    out = np.frombuffer(out, dtype=dtype if width == dtype.itemsize else f"u{width}").astype(dtype, copy=False)
    return np.cumsum(out, dtype=dtype) if rising else out


def home_count(n_blocks: int) -> int:
    return max(1, min(HOMES * n_blocks, LEAST_HOMES), n_blocks // BLOCKS_A_HOME)


def word_homes(blocked: DataFrame, n: int) -> DataFrame:
    """``n`` homes of words.

    A word's place is its rank among the home's words with classes, by bytes;
    these are listed with their counts (``words``, ``totals``). For each block
    there are its local numbers and the corpus counts, the words with places
    first (``places``, rising), then the others.
    """
    rare = RARE

    def run(words: pa.Table) -> pa.Table:
        coded = words.column("word").combine_chunks()
        coded = (coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
        of, names = coded.indices.to_numpy(), coded.dictionary
        totals = np.zeros(len(names), dtype=np.int64)
        np.add.at(totals, of, words.column("n").to_numpy())
        order = pc.sort_indices(names).to_numpy()
        classed = order[totals[order] >= rare]
        place = np.full(len(names), len(names), dtype=np.int64)
        place[classed] = np.arange(len(classed))
        block, number = words.column("block").to_numpy(), words.column("number").to_numpy()
        at = np.lexsort((number, place[of], block))
        block, number, of = block[at], number[at], of[at]
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        routes = []
        for a, b in zip(starts, [*starts[1:], len(block)], strict=True):
            places = place[of[a:b]]
            routes.append({
                "block": int(block[a]),
                "numbers": _squeeze(number[a:b], np.uint32),
                "counts": _squeeze(totals[of[a:b]], np.int64),
                "places": _squeeze(places[places < len(names)], np.uint32, True),
            })
        columns = [pa.array([words.column("home")[0].as_py()], pa.int32())]
        columns += [pa.array([names.take(pa.array(classed)).to_pylist()], pa.list_(pa.binary()))]
        # the last number is that of the training words without classes
        types = np.r_[totals[classed], int(((totals > 0) & (totals < rare)).sum()), int(totals[totals < rare].sum())]
        route = pa.struct([("block", pa.int64()), *[(c, pa.binary()) for c in ("numbers", "counts", "places")]])
        columns += [pa.array([_squeeze(types, np.int64)], pa.binary()), pa.array([routes], pa.list_(route))]
        return pa.Table.from_arrays(columns, names=["home", "words", "totals", "routes"])

    pairs = F.posexplode(F.arrays_zip("words", "counts")).alias("number", "pair")
    rows = blocked.where("fold IS NULL").select("block", pairs)
    word = F.col("pair.words")
    rows = rows.select(F.pmod(F.xxhash64(word), F.lit(n)).cast("int").alias("home"), "block", "number", word.alias("word"), F.col("pair.counts").alias("n"))
    return rows.groupBy("home").applyInArrow(run, _HOMES)


def vocabulary(homes: DataFrame) -> tuple[list[tuple[int, int, int]], int, int, int]:
    """(home, place, bucket) of the ``OWN`` most frequent words with classes; words with classes, training words and tokens in all."""
    most = OWN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                totals = _loosen(row["totals"], np.int64)
                counts, rest = totals[:-2], totals[-2:]
                top = sorted(range(len(counts)), key=lambda i: (-counts[i], row["words"][i]))[:most]
                rows = [(row["home"], i, row["words"][i], int(counts[i])) for i in top]
                rows.append((row["home"], -1, None, len(counts)))
                rows.append((row["home"], -2, None, int(rest[0]) + len(counts)))
                rows.append((row["home"], -3, None, int(counts.sum() + rest[1])))
                kinds = pa.int32(), pa.int32(), pa.binary(), pa.int64()
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["home", "place", "word", "n"])

    found = materialize(map_batches(homes.select("home", "words", "totals"), run, "home int, place int, word binary, n bigint"), "lm-top")
    sums = {r["place"]: r["n"] for r in found.where("place < 0").groupBy("place").agg(F.sum("n").alias("n")).collect()}
    top = found.where("place >= 0").orderBy(F.desc("n"), "word").limit(OWN).collect()  # fixed number of rows
    release(found)
    return [(r["home"], r["place"], i + 1) for i, r in enumerate(top)], *[int(sums.get(k, 0)) for k in (-1, -2, -3)]


def _by_home(own: list[tuple[int, int, int]]) -> dict[int, dict[int, int]]:
    out: dict[int, dict[int, int]] = {}
    for home, place, bucket in own:
        out.setdefault(home, {})[place] = bucket
    return out


def sequences(blocked: DataFrame, homes: DataFrame, own: list[tuple[int, int, int]]) -> DataFrame:
    """Documents in the numbers that the homes' order gives, with buckets (``OWN`` + 1: any other word) and word statistics."""
    at, other = _by_home(own), OWN + 1

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        numbers, counts, buckets, sizes = [], [], [], []
        for row in words.sort_by("home").to_pylist():
            places, mine = _loosen(row["places"], np.uint32, True), at.get(row["home"], {})
            numbers.append(_loosen(row["numbers"], np.uint32))
            counts.append(_loosen(row["counts"], np.int64))
            bucket = np.full(len(numbers[-1]), other, dtype=np.uint16)
            for i in np.flatnonzero(np.isin(places, np.array(list(mine), dtype=np.uint32))).tolist():
                bucket[i] = mine[int(places[i])]
            buckets.append(bucket)
            sizes.append(len(places))
        n = sum(map(len, numbers))
        count, bucket, new = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.uint16), np.zeros(n, dtype=np.uint32)
        before = 1
        for number, c, b, size in zip(numbers, counts, buckets, sizes, strict=True):
            count[number], bucket[number] = c, b
            new[number[:size]] = np.arange(before, before + size, dtype=np.uint32)
            before += size
        log_count = np.log10(count + ADD)
        lengths, known, logs, parts, shorts = [], [], [], [], []
        for data in docs.column("sequence").to_pylist():
            ids = np.frombuffer(data, dtype=np.uint32)
            lengths.append(len(ids) + 1)
            known.append(int((count[ids] > 0).sum()))
            logs.append(float(log_count[ids].sum()))
            parts.append(new[ids].tobytes())
            shorts.append(bucket[ids].tobytes() + b"\0\0")
        columns = [docs.column(c) for c in ("block", "doc_id", "fold")] + [pa.array(lengths, pa.int64()), pa.array(known, pa.int64())]
        columns += [pa.array(logs, pa.float64()), pa.array(parts, pa.binary()), pa.array(shorts, pa.binary())]
        return pa.Table.from_arrays(columns, names=_SEQUENCES.names)

    texts = blocked.where("fold IS NOT NULL").select("block", "doc_id", "fold", "sequence")
    route = homes.select("home", F.explode("routes").alias("r")).select("r.block", "home", "r.numbers", "r.counts", "r.places")
    return texts.groupBy("block").cogroup(route.groupBy("block")).applyInArrow(run, _SEQUENCES)


def neighbours(trained: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """Per bucket: counts by left class, by right class, and of itself behind itself: (buckets, 2 * k + 1)."""
    size = len(classes)
    shared = trained.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        out = np.zeros((size, 2 * k + 1), dtype=np.int64)
        for batch in cut(batches, "buckets"):
            # each document ends with the end token, which is also what precedes the next one's first word
            data = b"\0\0" + b"".join(batch.column("buckets").to_pylist())
            ids = np.frombuffer(data, dtype=np.uint16).astype(np.int64)
            before, after = ids[:-1], ids[1:]
            out[:, :k] += np.bincount(after * k + of[before], minlength=size * k).reshape(size, k)
            out[:, k : 2 * k] += np.bincount(before * k + of[after], minlength=size * k).reshape(size, k)
            out[:, -1] += np.bincount(after[before == after], minlength=size)
        rows = np.flatnonzero(out.any(axis=1))
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (2 * k + 1))
        counts = pa.ListArray.from_arrays(ends, pa.array(out[rows].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), counts], names=["bucket", "counts"])

    part = map_batches(trained.select("buckets"), run, "bucket int, counts array<long>")
    sums = part.groupBy("bucket").agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(2 * k + 1)]).alias("counts"))
    out = np.zeros((size, 2 * k + 1), dtype=np.float64)
    for row in sums.collect():  # the model: one row per bucket
        out[row["bucket"]] = row["counts"]
    return out


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def class_bigrams(counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Counts of (left class, class) from the buckets' left neighbours."""
    k = counts.shape[1] // 2
    out = np.zeros((k, k))
    np.add.at(out.T, classes, counts[:, :k])
    return out


def likelihood(bigrams: np.ndarray) -> float:
    """Class part of the training log likelihood."""
    return float(_phi(bigrams).sum() - _phi(bigrams.sum(axis=0)).sum() - _phi(bigrams.sum(axis=1)).sum())


def exchange(counts: np.ndarray, classes: np.ndarray, bigrams: np.ndarray | None = None) -> np.ndarray:
    """One sweep: every own word moves to the class that raises the likelihood most.

    ``bigrams`` are given if ``counts`` has only some of the words.
    """
    k = counts.shape[1] // 2
    classes = classes.copy()
    bigrams = class_bigrams(counts, classes) if bigrams is None else bigrams.copy()
    mass = counts[:, :k].sum(axis=1)
    for w in np.argsort(-mass, kind="stable"):
        if w in (0, len(classes) - 1) or mass[w] == 0:
            continue
        left, right, own = counts[w, :k].copy(), counts[w, k : 2 * k].copy(), counts[w, -1]
        g = classes[w]
        left[g] -= own
        right[g] -= own
        # take the bucket out of its class
        bigrams[:, g] -= left
        bigrams[g, :] -= right
        bigrams[g, g] -= own
        np.maximum(bigrams, 0, out=bigrams)  # neighbours' classes may have moved within this sweep
        base = _phi(bigrams)
        col = _phi(bigrams + left[:, None]) - base
        row = _phi(bigrams + right[None, :]) - base
        both = _phi(np.diag(bigrams) + left + right + own) - np.diag(base)
        into, outof = bigrams.sum(axis=0), bigrams.sum(axis=1)
        gain = col.sum(axis=0) - np.diag(col) + row.sum(axis=1) - np.diag(row) + both
        gain -= _phi(into + mass[w]) - _phi(into) + _phi(outof + mass[w]) - _phi(outof)
        gain[0] = -np.inf
        c = int(np.argmax(gain))
        classes[w] = c
        bigrams[:, c] += left
        bigrams[c, :] += right
        bigrams[c, c] += own
    return classes


def first_classes(k: int) -> np.ndarray:
    """By bucket: the most frequent words start in classes of their own, the others follow in turn; class 0 is the end's, 1 that of all other words."""
    classes = 2 + (np.arange(OWN + 2) - 1) % (k - 2)
    classes[0], classes[-1] = 0, 1
    return classes


def cluster(trained: DataFrame, k: int) -> np.ndarray:
    """Classes of the buckets."""
    classes = first_classes(k)
    counts = neighbours(trained, classes, k)
    best, found = classes, class_bigrams(counts, classes)
    while True:
        classes = exchange(counts, classes)
        counts = neighbours(trained, classes, k)
        bigrams = class_bigrams(counts, classes)
        rise = likelihood(bigrams) - likelihood(found)
        if rise > 0:
            best, found = classes, bigrams
        if rise <= RISE * found.sum():
            return best


# --- every word with a class ---------------------------------------------

#: Words with neighbours: per word its place at home, class, count beside itself, number of entries; entries are
#: (class to the left, or k + class to the right; count).
_PACKED = {"places": np.uint32, "classes": np.uint8, "own": np.int64, "sizes": np.uint8, "codes": np.uint8, "values": np.int64}
_CLASSED = "block bigint, home int, places binary, classes binary"
_COUNTED = "home int, " + ", ".join(f"{c} binary" for c in _PACKED) + ", tuned binary"
_STATE = "home int, " + ", ".join(f"{c} binary" for c in _PACKED) + ", bigrams array<bigint>, tuned array<bigint>, types array<bigint>"


def _pack(**arrays: np.ndarray) -> list[bytes]:
    """The places must rise."""
    return [_squeeze(arrays[c], t, c == "places") for c, t in _PACKED.items()]


def _unpack(row: dict) -> dict[str, np.ndarray]:
    return {c: _loosen(row[c], t, c == "places") for c, t in _PACKED.items()}


def _binaries(rows: list, k: int) -> pa.Array:
    return pa.array([r[k] for r in rows], pa.binary())


def _rises(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What each cell's ``_phi`` gains if a row's ``x`` is added."""
    return _phi(rows + x[:, None]) - _phi(rows)


def move_gains(bigrams: np.ndarray, classes: np.ndarray, own: np.ndarray, sizes: np.ndarray, codes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Likelihood of each word in each class (words, classes), up to a constant a word, if just that word moves.

    Words differ in few numbers: logarithms are taken once for each different (neighbours' class, count) and each
    different count of a word, then again only where the word's own counts are missing: at its own class.
    """
    k, n = len(bigrams), len(classes)
    word, at = np.repeat(np.arange(n), sizes), np.arange(n)
    both = np.zeros((n, 2 * k))
    both[word, codes] = values
    both[at, classes] -= own
    both[at, k + classes] -= own
    left, right = both[:, :k], both[:, k:]
    mass = left.sum(axis=1) + own
    added = left + right + own[:, None]
    w, c = np.nonzero(added)
    there = np.diag(bigrams)[c] - np.where(c == classes[w], added[w, c], 0.0)
    np.maximum(there, 0, out=there)  # a home's copy of the table is an estimate
    gain = np.zeros((n, k))
    gain[w, c] = _phi(there + added[w, c]) - _phi(there)
    codes = codes.astype(np.int64)
    for side, other, table, mine in ((left, right, bigrams, codes < k), (right, left, bigrams.T, codes >= k)):
        w, a = word[mine], codes[mine] % k
        x = side[w, a]
        if not x.all():  # nothing beside itself
            w, a, x = w[x != 0], a[x != 0], x[x != 0]
        if not len(w):
            continue
        g, i = classes[w], np.arange(len(w))
        different, place = np.unique(a + k * x, return_inverse=True)
        change = _rises(table[(different % k).astype(np.int64)], different // k)[place]
        cells = np.maximum(table[a, g] - x, 0)  # without the word itself
        change[i, g] = _phi(cells + x) - _phi(cells)
        same = np.flatnonzero(a == g)
        j, c = np.nonzero(other[w[same]])
        j = same[j]
        cells = np.maximum(table[a[j], c] - other[w[j], c], 0)
        change[j, c] = _phi(cells + x[j]) - _phi(cells)
        change[i, a] = 0.0  # the diagonal is counted above
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        gain[w[starts]] += np.add.reduceat(change, starts, axis=0)
    different, place = np.unique(mass, return_inverse=True)
    for total in (bigrams.sum(axis=0), bigrams.sum(axis=1)):
        change = _rises(np.tile(total, (len(different), 1)), different)[place]
        rest = np.maximum(total[classes] - mass, 0)
        change[at, classes] = _phi(rest + mass) - _phi(rest)
        gain -= change
    gain[:, 0] = -np.inf
    return gain


def _move(bigrams: np.ndarray, counts: np.ndarray, own: np.ndarray, old: np.ndarray, new: np.ndarray, times: float) -> np.ndarray:
    """The class bigrams after ``times`` such moves of words with these neighbours (the word itself not among them)."""
    k, out = len(bigrams), bigrams.copy()
    for classes, sign in ((old, -times), (new, times)):
        sums = (classes == np.arange(k)[:, None]).astype(float) @ np.c_[counts, own]
        out += sign * (sums[:, :k].T + sums[:, k : 2 * k] + np.diag(sums[:, -1]))
    return np.maximum(out, 0)


def best_classes(bigrams: np.ndarray, home: int, counted: dict[str, np.ndarray], free: np.ndarray, share: float, sweep: int, homes: int) -> np.ndarray:
    """The class of each word after a sweep in which a ``share`` of the ``free`` words (another one each sweep) may move."""
    k, classes = len(bigrams), counted["classes"].astype(np.int64)
    sizes, own = counted["sizes"].astype(np.int64), counted["own"].astype(float)
    mix = counted["places"].astype(np.uint64) * np.uint64(_ODD[0]) + np.uint64((home * _ODD[1] + sweep * _ODD[2]) % 2**64)
    mix = (mix ^ (mix >> np.uint64(29))) * np.uint64(_ODD[1])
    chosen = np.flatnonzero(free & ((mix >> np.uint64(40)).astype(float) < share * 2**24))
    if not len(chosen):
        return classes
    starts = np.cumsum(sizes) - sizes
    mass = np.add.reduceat(np.where(counted["codes"] < k, counted["values"], 0), starts)
    chosen = chosen[np.lexsort((mix[chosen], -mass[chosen]))]  # frequent words first
    entries, tokens = np.cumsum(sizes[chosen]), np.cumsum(mass[chosen])
    a, most = 0, tokens[-1] * MOVE_SHARE
    while a < len(chosen):
        e, t = (int(entries[a - 1]), int(tokens[a - 1])) if a else (0, 0)
        b = min(np.searchsorted(entries, e + MOVE_ENTRIES, side="right"), np.searchsorted(tokens, t + most, side="right"))
        words = chosen[a : max(a + 1, int(b))]
        a += len(words)
        n, i = sizes[words], np.arange(len(words))
        at = np.repeat(starts[words] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        codes, values, g = counted["codes"][at], counted["values"][at], classes[words]
        gain = move_gains(bigrams, g, own[words], n, codes, values)
        best = gain.argmax(axis=1)
        moves = gain[i, best] > gain[i, g] + 1e-9
        if moves.any():
            counts = np.zeros((len(words), 2 * k))
            counts[np.repeat(i, n), codes] = values
            counts[i, g] -= own[words]
            counts[i, k + g] -= own[words]
            classes[words] = np.where(moves, best, g)
            bigrams = _move(bigrams, counts[moves], own[words][moves], g[moves], best[moves], homes)
    return classes


_ODD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


def classed_words(
    homes: DataFrame, state: DataFrame | None, own: list[tuple[int, int, int]], start: np.ndarray, bigrams: np.ndarray | None = None,
    share: float = 0.0, sweep: int = 0, n: int = 1,
) -> DataFrame:
    """Per block and home the classes of the words in the order of their places: of ``state`` after moves, own ones by bucket."""
    names, at, k = [x.split()[0] for x in _CLASSED.split(", ")], _by_home(own), int(start.max()) + 1
    slim = homes.select("home", F.col("routes.block").alias("blocks"), F.col("routes.places").alias("routed"))
    if state is None:
        joined = slim.select("*", *[F.lit(None).cast("binary").alias(c) for c in _PACKED])
    else:
        # moves take far more time than their bytes tell
        parts = int(homes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        joined = slim.repartition(parts, "home").join(state.select("home", *_PACKED).repartition(parts, "home"), "home", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                routes = [_loosen(r, np.uint32, True) for r in row["routed"]]
                mine = at.get(row["home"], {})
                size = 1 + max((int(r[-1]) for r in routes if len(r)), default=-1)
                # a start over all classes: words that are all in one have no reason to part
                classes = (2 + (np.arange(size) * 7919 + row["home"]) % (k - 2)).astype(np.uint8)
                if row["places"] is not None:
                    counted = _unpack(row)
                    free = ~np.isin(counted["places"], np.array(list(mine), dtype=np.uint32))
                    moved = best_classes(bigrams, row["home"], counted, free, share, sweep, n) if share else counted["classes"]
                    classes[counted["places"]] = moved
                for place, bucket in mine.items():
                    classes[place] = start[bucket]
                columns = [pa.array(row["blocks"], pa.int64()), pa.array([row["home"]] * len(routes), pa.int32())]
                columns += [pa.array(row["routed"], pa.binary()), pa.array([_squeeze(classes[r], np.uint8) for r in routes], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(joined, run, _CLASSED)


def _block_classes(words: pa.Table) -> tuple[np.ndarray, list[dict]]:
    """A block's classes by number (0: the words without; the last one is the end token), and the homes in order."""
    rows = words.sort_by("home").to_pylist()
    each = [_loosen(r["classes"], np.uint8) for r in rows]
    return np.concatenate([np.ones(1, dtype=np.uint8), *each, np.zeros(1, dtype=np.uint8)]), rows


def word_neighbours(texts: DataFrame, classed: DataFrame, k: int) -> DataFrame:
    """Per home its words with the counts of their neighbours' classes, and the class bigrams these add up to.

    Bigrams whose right word has no class of its own are told by their left
    one's class or, of two such words, by an entry of their own beside the
    homes' rows (``home`` -1).
    """
    names = ["home", *_PACKED]

    def ids_of(docs: pa.Table, end: np.ndarray, wanted) -> np.ndarray:
        parts = [end]
        for data, f in zip(docs.column("sequence").to_pylist(), docs.column("fold").to_pylist(), strict=True):
            if wanted(f):
                parts += [np.frombuffer(data, dtype=np.uint32), end]
        return np.concatenate(parts)

    def block(docs: pa.Table, words: pa.Table) -> pa.Table:
        of, homes = _block_classes(words)
        size = len(of)
        end = np.array([size - 1], dtype=np.uint32)  # the end token, also before a document's first word
        ids = ids_of(docs, end, lambda f: f > 1)
        tuning = of[ids_of(docs, end, lambda f: f == 1)].astype(np.int64)
        # (word, class to its left or k + class to its right), sorted: takes less time and memory than a table of all there could be
        kind = np.uint32 if size * 2 * k < 1 << 32 else np.uint64
        near, ids = of[ids].astype(kind), ids.astype(kind)
        before, after = ids[:-1], ids[1:]
        own = np.bincount(after[before == after].astype(np.int64), minlength=size)
        entries = np.concatenate([after * kind(2 * k) + near[:-1], before * kind(2 * k) + (near[1:] + kind(k))])
        entries.sort()
        first = np.flatnonzero(np.r_[True, entries[1:] != entries[:-1]][: len(entries)])
        values = np.diff(first, append=len(entries))
        w, codes = (x.astype(np.int64) for x in np.divmod(entries[first], kind(2 * k)))
        sizes = np.bincount(w, minlength=size)
        ends = np.r_[0, np.cumsum(sizes)]
        # what no home sees: bigrams that end in a word without a class of its own, or in the end token
        bigrams = np.zeros((k, k), dtype=np.int64)
        for word, class_ in ((0, 1), (size - 1, 0)):
            left = slice(ends[word], ends[word] + np.searchsorted(codes[ends[word] : ends[word + 1]], k))
            bigrams[codes[left], class_] += values[left]
        tuned = np.bincount(tuning[:-1] * k + tuning[1:], minlength=k * k)
        rows, start = [(-1, *_pack(**dict.fromkeys(_PACKED, ())), np.r_[bigrams.ravel(), tuned].astype(np.int64).tobytes())], 1
        for row in homes:
            classes = _loosen(row["classes"], np.uint8)
            number = slice(start, start + len(classes))
            start += len(classes)
            some, mine = np.flatnonzero(sizes[number]), slice(ends[number.start], ends[number.stop])
            if len(some):
                places = _loosen(row["places"], np.uint32, True)[some]
                packed = _pack(places=places, classes=classes[some], own=own[number][some], sizes=sizes[number][some], codes=codes[mine], values=values[mine])
                rows.append((row["home"], *packed, None))
        columns = [pa.array([r[0] for r in rows], pa.int32()), *[_binaries(rows, 1 + i) for i in range(len(_PACKED) + 1)]]
        return pa.Table.from_arrays(columns, names=[*names, "tuned"])

    def home(parts: pa.Table) -> pa.Table:
        number, bigrams, tuned, types = parts.column("home")[0].as_py(), np.zeros((k, k), dtype=np.int64), np.zeros(k * k, dtype=np.int64), np.zeros(k, dtype=np.int64)
        if number < 0:
            for data in parts.column("tuned").to_pylist():
                both = np.frombuffer(data, dtype=np.int64)
                bigrams += both[: k * k].reshape(k, k)
                tuned += both[k * k :]
            packed = [None] * len(_PACKED)
        else:
            each = [_unpack(r) for r in parts.to_pylist()]
            n = 1 + max(int(x["places"].max()) for x in each)
            counts, own, classes = np.zeros(n * 2 * k, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            for x in each:  # a block names a word and a neighbour's class once
                counts[np.repeat(x["places"].astype(np.int64), x["sizes"]) * (2 * k) + x["codes"]] += x["values"]
                own[x["places"]] += x["own"]
                classes[x["places"]] = x["classes"]
            counts = counts.reshape(n, 2 * k)
            places = np.flatnonzero(counts.any(axis=1))
            counts, own, classes = counts[places], own[places], classes[places]
            w, codes = np.nonzero(counts)
            packed = _pack(places=places, classes=classes, own=own, sizes=np.bincount(w, minlength=len(places)), codes=codes, values=counts[w, codes])
            np.add.at(bigrams.T, classes, counts[:, :k])
            types = np.bincount(classes, minlength=k)
        columns = [pa.array([number], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]]
        columns += [pa.array([x.ravel().tolist()], pa.list_(pa.int64())) for x in (bigrams, tuned, types)]
        return pa.Table.from_arrays(columns, names=[*names, "bigrams", "tuned", "types"])

    counted = texts.groupBy("block").cogroup(classed.groupBy("block")).applyInArrow(block, _COUNTED)
    # what a block adds to the class bigrams is first summed over groups of blocks
    return counted.groupBy("home", F.when(F.col("home") < 0, F.pmod(F.xxhash64("tuned"), F.lit(64))).alias("part")).applyInArrow(home, _STATE)


def _summed(state: DataFrame, column: str, size: int) -> np.ndarray:
    out = np.zeros(size)
    for row in state.select(F.posexplode(column).alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[row["i"]] = row["n"]
    return out


def own_counts(state: DataFrame, own: list[tuple[int, int, int]], k: int) -> np.ndarray:
    """The neighbours of the own words as in :func:`neighbours`; zeros for all other buckets."""
    at = _by_home(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counted, mine = _unpack(row), at.get(row["home"], {})
                ends = np.cumsum(counted["sizes"].astype(np.int64))
                rows, buckets = [], []
                for w in np.flatnonzero(np.isin(counted["places"], np.array(list(mine), dtype=np.uint32))).tolist():
                    e, counts = slice(int(ends[w]) - int(counted["sizes"][w]), int(ends[w])), np.zeros(2 * k + 1, dtype=np.int64)
                    counts[counted["codes"][e]] = counted["values"][e]
                    counts[-1] = counted["own"][w]
                    rows.append(counts.tolist())
                    buckets.append(mine[int(counted["places"][w])])
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(rows, pa.list_(pa.int64()))], names=["bucket", "counts"])

    out = np.zeros((OWN + 2, 2 * k + 1))
    for row in map_batches(state.where("home >= 0").select("home", *_PACKED), run, "bucket int, counts array<bigint>").collect():
        out[row["bucket"]] = row["counts"]
    return out


def cluster_words(
    texts: DataFrame, homes: DataFrame, own: list[tuple[int, int, int]], start: np.ndarray, k: int
) -> tuple[DataFrame, np.ndarray, np.ndarray, list[float]]:
    """The state of all words with classes, the classes of the own ones by bucket, the class bigrams, and the likelihoods on the way."""
    n = homes.count()

    def counted(words: DataFrame) -> tuple[DataFrame, np.ndarray]:
        state = materialize(word_neighbours(texts, words, k), "lm-sweep")
        return state, _summed(state, "bigrams", k * k).reshape(k, k)

    state, bigrams = counted(classed_words(homes, None, own, start))
    kept, share, sweep, rise, last = [likelihood(bigrams)], 1.0, 0, np.inf, 0.0
    # small rises that grow lead away from a saddle
    while rise > max(0.0, min(last, RISE * bigrams.sum())) or share > LEAST_SHARE and rise <= 0:
        sweep, last = sweep + 1, rise if sweep else 0.0
        moved = exchange(own_counts(state, own, k), start, bigrams)
        tried, found = counted(classed_words(homes, state, own, moved, bigrams, share, sweep, n))
        rise = likelihood(found) - kept[-1]
        release(state if rise > 0 else tried)
        if rise > 0:
            state, bigrams, start = tried, found, moved
            kept.append(likelihood(found))
        else:  # too many moved at once: fewer next time
            share /= 4
    return state, start, bigrams, kept


def transitions(bigrams: np.ndarray, types: np.ndarray) -> np.ndarray:
    """Probability of (left class, class), over the class's tokens and types: times a word's count + ``ADD`` it is the word's."""
    total = bigrams.sum()
    prior = (bigrams.sum(axis=0) + ADD) / (total + ADD * len(bigrams))
    below = bigrams.sum(axis=0) + ADD * (types + 1)
    below[0] = 1.0  # the end token is all of its class
    return (bigrams + prior[None, :]) / (bigrams.sum(axis=1, keepdims=True) + 1.0) / below[None, :]


def weights(bigrams: np.ndarray, tuned: np.ndarray, types: np.ndarray) -> np.ndarray:
    """Per left class the weight of the class model that makes the ``tuned`` bigrams most probable beside the ``bigrams``.

    Both models give a word its count + ``ADD`` times a number that depends on
    the classes alone, so these bigrams are all that is needed.
    """
    n = bigrams.sum()
    plain = np.full(len(bigrams), 1 / (n + ADD * (types.sum() + 2)))
    plain[0] *= bigrams[:, 0].sum() + ADD
    mixed = WEIGHTS[:, None, None] * transitions(bigrams, types) + (1 - WEIGHTS)[:, None, None] * plain
    fits = (tuned * np.log(mixed)).sum(axis=2)
    # ten tokens more that are as all are, for left classes that hardly occur there
    fits += 10 * fits.sum(axis=1, keepdims=True) / max(1.0, tuned.sum())
    return WEIGHTS[fits.argmax(axis=0)]


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``."""
    blocked = materialize(blocks(docs, doc_id, text), "lm-blocks")
    n_blocks = blocked.where("fold IS NULL").count()
    n_docs = blocked.where("fold > 0").count()
    homes = materialize(word_homes(blocked, home_count(n_blocks)), "lm-homes")
    own, n_classed, n_words, n_tokens = vocabulary(homes)
    found = materialize(sequences(blocked, homes, own), "lm-sequences")
    release(blocked)
    k, n, v = class_count(n_classed), n_tokens + n_docs, n_words + (n_docs > 0)
    start = cluster(found.where("fold > 1"), k)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # each sweep meets the texts where they are: only classes and counts are shuffled
    texts = found.drop("buckets").repartition(parts, "block").persist(StorageLevel.DISK_ONLY)
    try:
        state, start, bigrams, _ = cluster_words(texts, homes, own, start, k)
        types = _summed(state, "types", k)
        types[1] += max(0, n_words - types.sum())
        tuned = _summed(state, "tuned", k * k).reshape(k, k)
        share = weights(bigrams, tuned, types)[:, None]
        plain = np.full(k, 1 / (n + ADD * (v + 1)))
        plain[0] *= n_docs + ADD
        logs = np.log10(share * transitions(bigrams + tuned, types) + (1 - share) * plain)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score"]

        def run(docs: pa.Table, words: pa.Table) -> pa.Table:
            of, _ = _block_classes(words)
            end, sums = np.array([len(of) - 1], dtype=np.uint32), []
            for data, known in zip(docs.column("sequence").to_pylist(), docs.column("log_counts").to_pylist(), strict=True):
                after = of[np.r_[np.frombuffer(data, dtype=np.uint32), end]]
                sums.append(known + float(logs[np.r_[0, after[:-1]], after].sum()))
            columns = [docs.column("doc_id"), pc.equal(docs.column("fold"), 0), *[docs.column(c) for c in names[2:5]]]
            return pa.Table.from_arrays([*columns, pa.array(sums, pa.float64())], names=names)

        words = classed_words(homes, state, own, start)
        scored = texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(
            run, "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"
        )
        scored = materialize(scored, "lm-scores")
    finally:
        texts.unpersist()
    release(found, homes, state)
    end = float(np.log10(n_docs + ADD))
    per_token = float(np.log10(n + ADD * (v + 1)))
    # the end token is known as soon as there is a training document
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.lit(int(n_docs > 0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.lit(end) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op6_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``."""
    return score(read_table(spark, sf_dir, "documents"))
