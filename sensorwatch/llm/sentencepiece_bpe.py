"""SentencePiece encoding and decoding by vectorised merge rounds.

Method: the distinct space-led words of a batch become one flat numpy array of
symbols. Each round looks up the piece that every adjacent pair would form,
takes the best (smallest) rank per word by a segmented minimum, merges all
leftmost occurrences of it at once, and compacts the array; words without a
further pair leave. Words are independent because no piece of the vocabulary
continues across a space mark (checked when the model is read).

Exactness: a word takes several merges in one round only if none of them makes
a pair of equal or better rank, in which case the order of the library (best
score, then leftmost) gives the same result; otherwise just its leftmost merge
is done. Space-only pieces, which all share one score, are merged last by the
same order.

Contract: null text counts as empty and gives no ids; texts of any length are
encoded whole; characters outside the vocabulary fall back to byte pieces;
repeated rows give repeated results; an empty table gives an empty result;
columns other than the text are carried along (a clashing ``ids`` column is
replaced).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import cut, map_batches, process_memo, quoted, read_table, remember, text_column

SPACE = "▁"
#: Words remembered per Python worker (about 0.2 KB each); later ones are encoded again where they occur.
MEMO_WORDS = 250_000
#: Text and ids handled at once in a Python worker, and symbols merged at once (a longer word goes alone): two
#: workers of each kind run beside an executor's heap, and merge rounds take about 100 bytes a symbol.
TEXT_BYTES, IDS, SYMBOLS = 1 << 19, 1 << 17, 1 << 17
_NONE = np.iinfo(np.int32).max


def load_model(path: str) -> dict:
    """The tables of a SentencePiece BPE model (identity normalizer, dummy prefix, byte fallback), as plain arrays."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.vocab_size()
    pieces = [sp.id_to_piece(i) for i in range(size)]
    plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(size)]
    index = {p: i for i, p in enumerate(pieces) if plain[i]}
    if any(SPACE in p.lstrip(SPACE) for p in index):
        raise ValueError("a piece continues across a space mark")
    if sp.encode("a ") != sp.encode("a" + SPACE) or sp.encode("ﬁ")[-1:] == sp.encode("fi")[-1:]:
        raise ValueError("the model normalizes its input")
    scores = np.array([sp.get_score(i) for i in range(size)])
    rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
    pairs = {}
    for piece, i in index.items():
        if piece.strip(SPACE):  # space-only pieces are merged last, see space_run
            for k in range(1, len(piece)):
                a, b = index.get(piece[:k]), index.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * size + b] = i
    byte_ids = np.full(256, -1, dtype=np.int32)
    raw = []
    for i in range(size):
        if sp.is_byte(i):
            byte_ids[int(pieces[i][3:5], 16)] = i
            raw.append(bytes([int(pieces[i][3:5], 16)]))
        else:
            raw.append(pieces[i].replace(SPACE, " ").encode() if plain[i] else b"")
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte fallback")
    keys = np.array(sorted(pairs), dtype=np.int64)
    return {
        "id": zlib.crc32(sp.serialized_model_proto()),
        "size": size,
        "chars": {p: i for p, i in index.items() if len(p) == 1},
        "rank": rank,
        "keys": keys,
        "vals": np.array([pairs[k] for k in keys.tolist()], dtype=np.int32),
        "bytes": byte_ids,
        "spaces": {len(p): i for p, i in index.items() if not p.strip(SPACE)},
        "raw": raw,
    }


class PairTable:
    """Open-addressing hash table over (left, right) symbol pairs, looked up for whole arrays."""

    BITS = 20

    def __init__(self, keys: np.ndarray, vals: np.ndarray, size: int):
        self.size = size
        self.keys = np.full(1 << self.BITS, -1, dtype=np.int64)
        self.vals = np.full(1 << self.BITS, -1, dtype=np.int32)
        todo_k, todo_v, self.probes = keys, vals, 0
        while len(todo_k):  # one probe distance per round; the first key of a slot stays
            at = (self._slot(todo_k) + self.probes) & ((1 << self.BITS) - 1)
            first = np.zeros(len(at), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = first & (self.keys[at] < 0)
            self.keys[at[put]], self.vals[at[put]] = todo_k[put], todo_v[put]
            todo_k, todo_v, self.probes = todo_k[~put], todo_v[~put], self.probes + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair forms, or -1."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        out = np.full(len(keys), -1, dtype=np.int32)
        for p in range(self.probes):
            at = (slot + p) & ((1 << self.BITS) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.vals[at[hit]]
        return out


class Encoder:
    """Encodes batches of texts with the tables of :func:`load_model`."""

    def __init__(self, model: dict, memo: dict | None = None):
        self.m = model
        self.table = PairTable(model["keys"], model["vals"], model["size"])
        self.rank = np.append(model["rank"], _NONE)  # index -1: no pair
        self.mark = model["chars"][SPACE]
        self.memo = {} if memo is None else memo
        self.runs: dict[int, list[int]] = {}

    # --- words -----------------------------------------------------------

    @staticmethod
    def words(text: str) -> list[str]:
        """Keys of the space-led words of a text: the word behind its first space mark, further marks as spaces."""
        if not text:
            return []
        parts = text.replace(SPACE, " ").split(" ")
        if "" not in parts:
            return parts
        out, empty = [], 0
        for p in parts:
            if p:
                out.append(" " * empty + p)
                empty = 0
            else:
                empty += 1
        if empty:
            out.append(" " * (empty - 1))
        return out

    def space_run(self, n: int) -> list[int]:
        """Pieces of n adjacent space marks: equal scores, so always the leftmost pair that forms a piece."""
        if n not in self.runs:
            known, done, left = self.m["spaces"], [1], n - 1
            while True:
                if len(done) > 1 and done[-2] + done[-1] in known:
                    done[-2:] = [done[-2] + done[-1]]
                elif left and done[-1] + 1 in known:
                    done[-1] += 1
                    left -= 1
                elif left:
                    done.append(1)
                    left -= 1
                else:
                    break
            self.runs[n] = [known[k] for k in done]
        return self.runs[n]

    def merge_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian int32 bytes, about ``SYMBOLS`` characters at once."""
        out, ends = [], np.cumsum([len(w) + 1 for w in words])
        while len(out) < len(words):
            start = len(out)
            stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SYMBOLS, side="right"))
            out += self._merge(words[start : max(start + 1, stop)])
        return out

    def _merge(self, words: list[str]) -> list[bytes]:
        """Merge rounds over all these words at once."""
        texts = [SPACE + w.replace(" ", SPACE) for w in words]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        flat = "".join(texts)
        points = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32)
        distinct, inverse = np.unique(points, return_inverse=True)
        char_ids = np.array([self.m["chars"].get(chr(c), -1) for c in distinct.tolist()], dtype=np.int32)
        sym = char_ids[inverse]
        sym = np.where(sym < 0, -1 - points.astype(np.int64), sym)  # unknown characters: below -1, never merged
        word = np.repeat(np.arange(len(texts)), lengths)
        done_sym, done_word = [], []
        pair = np.full(len(sym), -1, dtype=np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        pair[inner] = self.table.merged(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(sym)])
            ranks = self.rank[pair]
            best = np.minimum.reduceat(ranks, starts)
            over = best == _NONE
            if over.any():  # these words are finished
                keep = np.repeat(~over, counts)
                done_sym.append(sym[~keep])
                done_word.append(word[~keep])
                sym, word, pair, ranks = sym[keep], word[keep], pair[keep], ranks[keep]
                if not len(sym):
                    break
                best, counts = best[~over], counts[~over]
            at = np.flatnonzero(ranks == np.repeat(best, counts))
            # overlapping occurrences (x x x): every other one from the left of each run
            run_start = np.r_[True, np.diff(at) != 1]
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
            at = at[nth % 2 == 0]
            first = np.r_[True, word[at[1:]] != word[at[:-1]]]
            if not first.all():
                at = at[first | ~self._unsafe(sym, word, pair, at, first)]
            sym[at] = pair[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, word, pair = sym[keep], word[keep], pair[keep]
            changed = place[at]
            before = changed[changed > 0] - 1
            changed = np.concatenate([changed, before])
            pair[changed] = -1
            changed = changed[changed + 1 < len(sym)]
            changed = changed[word[changed] == word[changed + 1]]
            pair[changed] = self.table.merged(sym[changed], sym[changed + 1])
        return self._collect(len(texts), done_sym, done_word)

    def _unsafe(self, sym, word, pair, at, first) -> np.ndarray:
        """Per occurrence: whether its word has one that would form a pair of equal or better rank.

        Looked at per occurrence: the new symbol with its left and right
        neighbours, as they are and as the neighbouring occurrence leaves them.
        """
        new, own = pair[at], self.rank[pair[at]]
        bad = np.zeros(len(at), dtype=bool)
        right = np.minimum(at + 2, len(sym) - 1)
        has_right = (at + 2 < len(sym)) & (word[right] == word[at])
        left = np.maximum(at - 1, 0)
        has_left = (at > 0) & (word[left] == word[at])
        bad |= has_right & (self.rank[self.table.merged(new, sym[right])] <= own)
        bad |= has_left & (self.rank[self.table.merged(sym[left], new)] <= own)
        touch = np.r_[(at[1:] - at[:-1] == 2) & (word[at[1:]] == word[at[:-1]]), False]
        bad |= touch & (self.rank[self.table.merged(new, new)] <= own)
        group = np.cumsum(first) - 1
        return np.bincount(group, weights=bad)[group] > 0

    def _collect(self, n: int, done_sym: list, done_word: list) -> list[bytes]:
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        ends = np.searchsorted(word, np.arange(n), side="right")
        odd = set(word[sym < 0].tolist())  # byte fallback
        lead = (sym[:-1] == self.mark) & (sym[1:] == self.mark) & (word[:-1] == word[1:])
        odd |= set(word[:-1][lead].tolist())  # adjacent space marks
        ids = sym.astype(np.int32)
        out, start = [], 0
        for w, end in enumerate(ends.tolist()):
            out.append(self._odd(sym[start:end].tolist()) if w in odd else ids[start:end].tobytes())
            start = end
        return out

    def _odd(self, sym: list[int]) -> bytes:
        n = 0
        while n < len(sym) and sym[n] == self.mark:
            n += 1
        ids = list(self.space_run(n)) if n else []
        for s in sym[n:]:
            ids.extend(self.m["bytes"][list(chr(-1 - s).encode())].tolist() if s < 0 else [s])
        return np.array(ids, dtype=np.int32).tobytes()

    # --- texts -----------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32 bytes."""
        memo, keyed = self.memo, [self.words(t) for t in texts]
        new = set()
        for keys in keyed:
            new.update(keys)
        new.difference_update(memo)
        here = memo
        if new:
            found = dict(zip(words := list(new), self.merge_words(words), strict=True))
            here = remember(memo, found, MEMO_WORDS)
        get = here.__getitem__
        return [b"".join(map(get, keys)) for keys in keyed]

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids: pieces joined, the dummy space removed, broken byte pieces replaced."""
        return decode_ids(ids, self.m["raw"])


def decode_ids(ids: list[int], raw: list[bytes]) -> str:
    data = b"".join([raw[i] for i in ids])
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _encoder(shared) -> Encoder:
    memo = process_memo("sentencepiece")
    return Encoder(shared.value, memo.setdefault(shared.value["id"], {}))


def encode(docs: DataFrame, model_path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with an ``into`` column: the ids of the whole text (``array<int>``), all other columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    kept = [c for c in docs.columns if c.lower() != into.lower()]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(into, T.ArrayType(T.IntegerType(), False))])
    hidden = "\u0001text"
    source = docs.select(*[quoted(c) for c in kept], text_column(text).alias(hidden))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in cut(batches, hidden, TEXT_BYTES):
            parts = encoder.encode(batch.column(hidden).to_pylist())
            ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(parts), dtype=np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends), values)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [ids], names=[*kept, into])

    return map_batches(source, run, schema, memo="sentencepiece")


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with an ``into`` column: the text of its ids (null ids: empty), all other columns unchanged."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_model(model_path)["raw"])
    kept = [c for c in encoded.columns if c.lower() != into.lower()]
    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(into, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shared.value
        for batch in batches:
            lists, start = batch.column(ids), 0
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            while start < batch.num_rows:
                stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + IDS, side="right"))
                part = batch.slice(start, min(256, max(1, stop - start)))
                each = [x.values.to_numpy().tolist() if x.is_valid else [] for x in part.column(ids)]
                texts = pa.array([decode_ids(x, raw) for x in each], pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], texts], names=[*kept, into])
                start += part.num_rows

    return map_batches(encoded.select(*map(quoted, kept)), run, schema, memo="sentencepiece")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the encoded and decoded texts of all ``documents``."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    shared = spark.sparkContext.broadcast(load_model(public_tokenizers.path("piece_bpe_32k.model")))
    source = docs.select("doc_id", text_column().alias("text"))
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        names = [str(i) for i in range(encoder.m["size"])]
        for batch in cut(batches, "text", TEXT_BYTES):
            n, ids_sha, text_sha = [], [], []
            for part in encoder.encode(batch.column("text").to_pylist()):
                ids = np.frombuffer(part, dtype=np.int32).tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(source, run, schema, memo="sentencepiece")
