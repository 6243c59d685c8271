"""Token ids in ORC files.

Method: documents are range-sorted by id, encoded, and written as ORC: id lists
in stripes with integer run-length encoding, row indexes, and Bloom filters on
``doc_id``. Files can be read stripe by stripe in parallel; a lookup of a few
documents is pruned by the min/max of files, stripes and row groups and by the
Bloom filters (:func:`read_documents`).

The encoding splits a text at single spaces and line feeds between other
characters (the pre-tokenizer always starts a new token there), encodes each
distinct word of a batch once, and joins the stored ids.

Contract: null text counts as empty (its ids are just the end id); null
``doc_id`` sorts first; repeated ids keep all their rows, in the order of their
text's hash; an empty table gives an empty file set; only the id and text
columns are read, other columns are not stored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..session import checkpoint_root
from .common import BROADCAST_ROWS, cut, map_batches, process_memo, quoted, read_table, text_column

#: Words remembered per Python worker (about 0.2 KB each); beyond that the memory starts anew.
MEMO_WORDS = 600_000
#: White space other than the space and the line feed; a text without it is split at those two alone.
_OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Words encoded in one call, joined by the character that separates them in a text.
_JOINED = 64

#: Writer settings: stripes of 16 MB, an index entry every 1,000 rows, Bloom filters on the document id.
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def is_regular(text: str) -> bool:
    """Whether each white space of a text is one space or line feed between other characters."""
    if not text or text[0].isspace() or text[-1].isspace():
        return False
    if "  " in text or "\n " in text or " \n" in text or "\n\n" in text:
        return False
    return not any(c in text for c in _OTHER_SPACE)


def word_numbers() -> dict[str, int]:
    """Numbers words in the order they are first asked for."""
    return defaultdict(count().__next__)


class TokenEncoder:
    """Encodes texts with a tokenizers file, as the library does with it as loaded.

    A text that holds the string of an added token goes to the library whole;
    with ``controls=False`` such strings are ordinary text.

    Texts are split at their spaces, with a space put before each line feed: a
    word stands for itself behind a space, or has its line feed in front. Words
    are numbered as they come; their ids are looked up by number once all new
    words of a batch are encoded.
    """

    def __init__(self, tokenizer_json: str, memo: dict | None = None, controls: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = not controls
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if controls or not t.special]
        self.memo = {} if memo is None else memo
        self.line = self._ids("\n")
        self.led = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # tokens that begin with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.led[i] = token.startswith("\u0120")

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _groups(self, words: list[str], led: bool) -> list[bytes]:
        """Ids of words that follow a space (``led``) or start a line, encoded in joined groups."""
        out: list[bytes] = []
        groups = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        joined = [" " + " ".join(g) if led else "\n".join(g) + "\n" for g in groups]
        newline = int(np.frombuffer(self.line, dtype="<u4")[0])
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            cuts = np.flatnonzero(self.led[ids]) if led else np.flatnonzero(ids == newline)
            if len(cuts) != len(group):
                out.extend(self._ids(" " + w if led else w) for w in group)
            elif led:
                data, at = ids.tobytes(), (4 * np.r_[cuts, len(ids)]).tolist()
                out.extend(data[a:b] for a, b in zip(at, at[1:], strict=False))
            else:
                data, at = ids.tobytes(), (4 * np.r_[-1, cuts]).tolist()
                out.extend(data[a + 4 : b] for a, b in zip(at, at[1:], strict=False))
        return out

    def _encode_new(self) -> None:
        """Find the ids of all words that were numbered since the last call."""
        numbers, known = self.memo["numbers"], self.memo["ids"]
        start = len(known)
        fresh = list(islice(reversed(numbers), len(numbers) - start))[::-1]
        # a full stop or comma behind a letter is a token of its own; the word before it is remembered too
        marked = [i for i, w in enumerate(fresh) if w[-1] in ".," and w[-2:-1].isalpha()]
        bare = [numbers[fresh[i][:-1]] for i in marked]
        # words before a mark that are new themselves
        fresh += list(islice(reversed(numbers), len(numbers) - start - len(fresh)))[::-1]
        known.extend([b""] * len(fresh))
        whole = bytearray(b"\1") * len(fresh)
        for i in marked:
            whole[i] = 0
        led = [i for i, w in enumerate(fresh) if whole[i] and w[0] != "\n"]
        for i, ids in zip(led, self._groups([fresh[i] for i in led], True), strict=True):
            known[start + i] = ids
        lines = [i for i, w in enumerate(fresh) if whole[i] and w[0] == "\n"]
        for i, ids in zip(lines, self._groups([fresh[i][1:] for i in lines], False), strict=True):
            known[start + i] = self.line + ids
        mark = {".": self._ids("."), ",": self._ids(",")}
        for i, word in zip(marked, bare, strict=True):
            known[start + i] = known[word] + mark[fresh[i][-1]]

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """Ids of each text and the end id, as little-endian uint32 bytes."""
        memo = self.memo
        if not memo or len(memo["numbers"]) > MEMO_WORDS:
            memo.update(numbers=word_numbers(), ids=[])
        number, known = memo["numbers"].__getitem__, memo["ids"]
        held = [any(c in t for c in self.added) for t in texts]
        numbered = [
            list(map(number, ("\n" + t.replace("\n", " \n")).split(" "))) if not h and is_regular(t) else t
            for t, h in zip(texts, held, strict=True)
        ]
        self._encode_new()
        last, get = np.array([end], dtype="<u4").tobytes(), known.__getitem__
        return [
            b"".join(map(get, x))[len(self.line) :] + last
            if not isinstance(x, str)
            else (self._ids(x) if h else self._irregular(x)) + last
            for x, h in zip(numbered, held, strict=True)
        ]

    def _irregular(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = _CUT.split(text)
        return b"".join([self._ids(first), *[self._ids(" " + w) for w in rest]])


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("part_start", T.LongType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    controls: bool = True,
) -> None:
    """Encode all documents and write them to ORC files at ``path`` in ascending order of the document id.

    Strings of added tokens inside a text become those tokens, as in the library;
    with ``controls=False`` those of special ones are ordinary text.

    ``part`` numbers the files in order, ``part_start`` counts the ids before a
    document within its file.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select(quoted(doc_id).cast("long").alias("doc_id"), text_column(text).alias("text"))
    tie = F.xxhash64("text")  # repeated ids spread over files too
    source = source.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        encoders = process_memo("token_files")
        if (shared.value, controls) not in encoders:
            encoders[shared.value, controls] = TokenEncoder(shared.value, controls=controls)
        encoder = encoders[shared.value, controls]
        for batch in cut(batches, "text"):
            encoded = encoder.encode(batch.column("text").to_pylist(), end_id)
            n = np.array([len(e) // 4 for e in encoded], dtype=np.int64)
            ends = np.cumsum(n)
            ids = pa.ListArray.from_arrays(
                pa.array(np.r_[0, ends].astype(np.int32)), pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"))
            )
            columns = [
                batch.column("doc_id"),
                pa.array(np.full(len(n), part, dtype=np.int32)),
                pa.array(before + ends - n),
                pa.array(n.astype(np.int32)),
                ids,
            ]
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(columns, names=SCHEMA.names)

    writer = map_batches(source, run, SCHEMA, memo="token_files").write.format("orc")
    writer.options(**ORC_OPTIONS).save(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """Ids of a few documents: the predicate reaches the ORC reader, which prunes files, stripes and row groups."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "n_tokens", "ids")


def with_starts(tokens: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before, from per-file totals (one row per file, no ids read)."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).cast("long").alias("_before"))
    if totals.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    joined = tokens.join(offsets, F.col("part") == F.col("_part"))
    return joined.withColumn("start", F.col("_before") + F.col("part_start")).drop("_part", "_before")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts, lengths and checksums of all ``documents``, from the ORC files that hold their ids."""
    import public_tokenizers

    path = f"{checkpoint_root(spark)}/llm/tokens-{uuid.uuid4().hex[:12]}"
    docs = read_table(spark, sf_dir, "documents")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    tokens = with_starts(read_tokens(spark, path)).select("doc_id", "start", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = ids.values.to_numpy().astype("<u4", copy=False)
            offsets = ids.offsets.to_numpy()
            view = memoryview(np.ascontiguousarray(values)).cast("B")
            spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            crc = pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in spans], pa.int64())
            n = pa.array([b - a for a, b in spans], pa.int64())
            columns = [batch.column("doc_id"), batch.column("start"), n, crc]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_batches(tokens, run, "doc_id long, start long, n_tokens long, ids_crc32 long", memo="token_files")
