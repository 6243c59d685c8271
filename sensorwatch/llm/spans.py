"""Spans found in texts: leftmost, non-overlapping matches of a kind, and their digests.

A span is (kind, start, end) in code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import cut, map_batches, quoted, text_column

Span = tuple[str, int, int]


def ordered(spans: list[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def outside(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that overlap none of ``base``."""
    return [s for s in spans if not any(s[1] < b[2] and b[1] < s[2] for b in base)]


def matches(pattern: re.Pattern, text: str, kind: str, keep) -> list[Span]:
    return [(kind, m.start(), m.end()) for m in pattern.finditer(text) if keep(m)]


def with_spans(docs: DataFrame, make_finder, text: str = "text", into: str = "found") -> DataFrame:
    """``docs`` with an array ``into`` of (kind, start, end, base, score).

    ``make_finder()`` runs once per task and returns a function from a list of
    texts to a list of (base spans, added spans with scores).
    """
    kept = [c for c in docs.columns if c.lower() != into.lower()]
    span = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(into, T.ArrayType(span))])
    arrow = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]
        )
    )
    hidden = "\u0001text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make_finder()
        for batch in cut(batches, hidden):
            rows = []
            for base, added in find(batch.column(hidden).to_pylist()):
                one = [{"kind": k, "start": a, "end": b, "base": True, "score": 1.0} for k, a, b in base]
                one += [{"kind": k, "start": a, "end": b, "base": False, "score": s} for k, a, b, s in added]
                rows.append(one)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(rows, arrow)], names=[*kept, into])

    return map_batches(docs.select(*map(quoted, kept), text_column(text).alias(hidden)), run, schema, memo="pii")


def digests(found: DataFrame, base_kinds: Sequence[str], kinds: Sequence[str], into: str = "found") -> DataFrame:
    """Per document: counts and digest of the base spans, and all spans, from the operator's spans."""
    names = ["doc_id", *[f"n_{k}" for k in base_kinds], "base_sha256", "spans"]
    fields = [found.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names[1:-2]]]
    fields += [T.StructField(n, T.StringType()) for n in names[-2:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shas, spans = [[] for _ in base_kinds], [], []
            for row in batch.column(into).to_pylist():
                base = ordered([(s["kind"], s["start"], s["end"]) for s in row if s["base"]], kinds)
                both = ordered([(s["kind"], s["start"], s["end"]) for s in row], kinds)
                for out, kind in zip(counts, base_kinds, strict=True):
                    out.append(sum(s[0] == kind for s in base))
                shas.append(sha256(joined(base)))
                spans.append(joined(both))
            columns = [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts]]
            columns += [pa.array(shas, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(found.select("doc_id", into), run, T.StructType(fields), memo="pii")
