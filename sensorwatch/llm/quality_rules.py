"""Quality rules with thresholds that adapt to each language and source.

Method: every document gets a few text metrics. For each metric a mergeable
quantile sketch is kept per (language, source): counts of logarithmic buckets,
so that sketches merge by adding counts and a quantile is within 1 % of the
true value. The upper fence of a group is its third quartile plus three
interquartile ranges (at least a small slack). A group's quartiles are averaged
with its language's, these counting as ``PRIOR`` documents, so that a fence
varies smoothly with the number of documents; the quartiles of all documents
stand beside a language's in the same way, but only ever loosen a fence: no
document is rejected for being unlike other languages. Documents are joined with
their group's fences and rejected if a metric is beyond one.

The sketches are rows (group, metric, bucket, count) made by map-side partial
sums: a group with a third of all documents sends at most one row per task and
bucket. Nothing of a document goes to the driver.

Contract: null text has no words; null language or source is a group of its
own; documents under the base rule's word count are rejected by the base rule;
equal rows get equal verdicts; an empty table gives an empty result; extra
columns are carried along, also ones named like a metric (see :func:`judge`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import cut, free_name, join_small, map_batches, materialize, quoted, read_table, text_column

#: Base rule (given): fewer words than this, or more than 20 % of words in repeated windows.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW_WORDS = 5
SYMBOLS = b"#*$%&|<>"

#: Adaptive rules: metric -> least distance of the fence from the quartile. All are ratios of 0 and more.
SLACK = {
    "symbol_ratio": 0.05,
    "capital_ratio": 0.25,
    "mark_ratio": 0.10,
    "word_length": 5.0,
    "dup_line_ratio": 0.50,
    "repeat_ratio": 0.20,
}
FENCE_RANGES = 3.0
#: Documents that the quartiles of the wider group count as.
PRIOR = 100.0
#: Ratio between the bounds of a sketch bucket: quantiles are within 1 %.
GAMMA = 1.02

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks"]
METRICS_TYPE = T.StructType([T.StructField(c, T.LongType(), False) for c in _COUNTS])

_SPACES = b" \t\n\x0b\x0c\r"


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.int32)
    table[list(chars)] = 1
    return table


def _byte_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts of characters by kind per text, over one buffer of all texts."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    starts_char = (np.arange(256) & 0xC0) != 0x80  # not a UTF-8 continuation byte
    kinds = {
        "word_chars": starts_char.astype(np.int32) - _table(_SPACES),
        "n_symbols": _table(SYMBOLS),
        "n_capitals": _table(bytes(range(65, 91))),
        "n_marks": _table(b"!?"),
    }
    out = {}
    for name, table in kinds.items():
        total = np.r_[0, np.cumsum(table[data], dtype=np.int32)]  # of one chunk of texts
        out[name] = (total[ends[1:]] - total[ends[:-1]]).astype(np.int64)
    return out


_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


def repeated_words(ids: np.ndarray) -> int:
    """Words inside five-word windows that occur twice or more (windows compared by a 64-bit mix of word numbers)."""
    n = len(ids) - WINDOW_WORDS + 1
    if n < 2:
        return 0
    h = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW_WORDS):
        h = (h ^ ids[k : k + n]) * np.uint64(_MIX[k])
        h ^= h >> np.uint64(31)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    edge[at + WINDOW_WORDS] -= 1
    return int((np.cumsum(edge) > 0).sum())


def text_metrics(texts: list[bytes]) -> list[np.ndarray]:
    """The counts of ``METRICS_TYPE`` for each UTF-8 text, column by column."""
    numbers: dict[bytes, int] = {}
    n_words, dup, repeat, lines = [], [], [], []
    for text in texts:
        words = text.split()
        n_words.append(len(words))
        with_words = [x for x in text.split(b"\n") if x.strip()]
        lines.append(len(with_words))
        dup.append(len(with_words) - len(set(with_words)))
        if len(words) > WINDOW_WORDS and len(set(words)) < len(words):
            for w in words:
                if w not in numbers:
                    numbers[w] = len(numbers) + 1
            repeat.append(repeated_words(np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))))
        else:
            repeat.append(0)
    by = _byte_counts(texts)
    long = lambda x: np.asarray(x, dtype=np.int64)
    first = [long(n_words), by["word_chars"], by["n_symbols"], long(dup), long(repeat)]
    return [*first, long(lines), by["n_capitals"], by["n_marks"]]


def with_metrics(docs: DataFrame, text: str = "text", into: str = "metrics", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and a struct ``into`` of the counts."""
    kept = docs.columns if keep is None else keep
    hidden = free_name([*kept, into], "_text")
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(into, METRICS_TYPE, False)])
    # a text that is kept goes to Python once
    once = text in kept and isinstance(docs.schema[text].dataType, T.StringType)
    source = docs.select(*map(quoted, kept), *([] if once else [text_column(text).cast("binary").alias(hidden)]))
    hidden = text if once else hidden

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, hidden):
            counts = text_metrics(batch.column(hidden).cast(pa.binary()).fill_null(b"").to_pylist())
            struct = pa.StructArray.from_arrays([pa.array(c) for c in counts], names=_COUNTS)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], struct], names=[*kept, into])

    return map_batches(source, run, schema)


def ratios(metrics: str = "metrics") -> dict[str, Column]:
    """The adaptive metrics of a document, from its counts."""
    of = lambda name: F.col(f"{metrics}.{name}").cast("double")
    per = lambda a, b: F.when(of(b) > 0, of(a) / of(b)).otherwise(F.lit(0.0))
    return {
        "symbol_ratio": per("n_symbols", "word_chars"),
        "capital_ratio": per("n_capitals", "word_chars"),
        "mark_ratio": per("n_marks", "word_chars"),
        "word_length": per("word_chars", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "repeat_ratio": per("n_repeat_words", "n_words"),
    }


def _base_failed(metrics: str = "metrics") -> Column:
    n, repeat = F.col(f"{metrics}.n_words"), F.col(f"{metrics}.n_repeat_words")
    return (n < MIN_WORDS) | (repeat * 100 > n * MAX_REPEAT_PERCENT)


def sketch(measured: DataFrame, lang: str = "lang", source: str = "source", metrics: str = "metrics") -> DataFrame:
    """Rows (lang, source, metric, bucket, n): the quantile sketch of each metric per group.

    Sketches of several inputs merge by summing ``n``. Bucket 0 holds values
    under 0.0001; bucket b > 0 holds ``[0.0001 * GAMMA^(b-1), 0.0001 * GAMMA^b)``.
    Documents that the base rule rejects are left out, as they have few words or are mostly repeats.
    """
    pairs = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in ratios(metrics).items()]
    rows = measured.where(~_base_failed(metrics)).select(
        quoted(lang).alias("lang"), quoted(source).alias("source"), F.explode(F.array(*pairs)).alias("m")
    )
    bucket = F.when(F.col("m.value") < 1e-4, 0).otherwise(
        1 + F.floor(F.log(F.col("m.value") / F.lit(1e-4)) / F.lit(math.log(GAMMA)))
    )
    keys = ["lang", "source", "metric", "bucket"]
    rows = rows.select("lang", "source", F.col("m.metric").alias("metric"), bucket.cast("int").alias("bucket"))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    """The sketches of wider groups: counts added up over all other keys."""
    return sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """One row per group and metric: ``size`` and the named quantiles (middle of the bucket that holds the rank)."""
    group = Window.partitionBy(*keys, "metric")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(F.lit(1e-4) * F.pow(F.lit(GAMMA), F.col("bucket") - 0.5))
    ranked = sketches.select(
        *keys, "metric", value.alias("v"), F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("size")
    )
    found = [
        F.min(F.when(F.col("upto") >= F.greatest(F.lit(1.0), F.ceil(F.col("size") * q)), F.col("v"))).alias(name)
        for name, q in at.items()
    ]
    return ranked.groupBy(*keys, "metric").agg(F.first("size").alias("size"), *found)


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source): the upper fence of each metric."""
    quartiles = {"q1": 0.25, "q3": 0.75}

    def part(name: str, *keys: str) -> DataFrame:
        found = quantiles(merge(sketches, *keys), list(keys), quartiles)
        return found.select(*keys, "metric", *[F.col(c).alias(f"{c}_{name}") for c in ("size", *quartiles)])

    def blend(name: str, wider: dict[str, Column]) -> dict[str, Column]:
        size = F.col(f"size_{name}").cast("double")
        return {q: (size * F.col(f"{q}_{name}") + PRIOR * wider[q]) / (size + PRIOR) for q in quartiles}

    def above(at: dict[str, Column]) -> Column:
        slack = F.create_map(*[F.lit(x) for pair in SLACK.items() for x in pair])[F.col("o.metric")]
        return at["q3"] + F.greatest(F.lit(FENCE_RANGES) * (at["q3"] - at["q1"]), slack)

    own, by_lang, overall = part("own", "lang", "source"), part("lang", "lang"), part("all")
    joined = (
        own.alias("o")
        .join(by_lang.alias("l"), F.expr("o.lang <=> l.lang AND o.metric = l.metric"))
        .join(overall.alias("a"), F.expr("o.metric = a.metric"))
    )
    of_lang, of_all = ({q: F.col(f"{q}_{name}") for q in quartiles} for name in ("lang", "all"))
    fence = F.greatest(above(blend("own", of_lang)), above(blend("own", blend("lang", of_all))))
    rows = joined.select("o.lang", "o.source", "o.metric", fence.alias("fence"))
    found = [F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"max_{m}") for m in SLACK]
    return rows.groupBy("lang", "source").agg(*found)


def judge(
    measured: DataFrame, fences: DataFrame, lang: str = "lang", source: str = "source", metrics: str = "metrics",
    into: str = "verdict",
) -> DataFrame:
    """Adds a struct ``into``: ``base_failed``, ``kept``, and the names of the adaptive rules that a document breaks.

    Metrics and verdict live in two structs, so columns of the input named like
    one of their fields stay as they are.
    """
    key_l, key_s = free_name(measured.columns, "_lang"), free_name(measured.columns, "_source")
    limit = free_name([*measured.columns, key_l, key_s], "_limits")
    small = fences.select(
        F.col("lang").alias(key_l), F.col("source").alias(key_s), F.struct(*[f"max_{m}" for m in SLACK]).alias(limit)
    )
    keyed = measured.withColumns({key_l: quoted(lang), key_s: quoted(source)})
    joined = join_small(keyed, small, [key_l, key_s]).drop(key_l, key_s)
    broken = F.filter(
        F.array(*[F.when(v > F.col(f"{limit}.max_{m}"), F.lit(m)) for m, v in ratios(metrics).items()]),
        lambda x: x.isNotNull(),
    )
    verdict = F.struct(
        _base_failed(metrics).alias("base_failed"),
        (~_base_failed(metrics) & (F.size(broken) == 0)).alias("kept"),
        broken.alias("broken"),
    )
    return joined.withColumn(into, verdict).drop(limit)


def filter_documents(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """The documents that pass the base and the adaptive rules, with their columns unchanged.

    One pass makes the sketches (no text is shuffled or written), a second one
    measures again and filters.
    """
    m, v = free_name(docs.columns, "_metrics"), free_name(docs.columns, "_verdict")
    keys = with_metrics(docs.select(quoted(lang).alias("lang"), quoted(source).alias("source"), quoted(text).alias("text")),
                        keep=["lang", "source"])
    fences = materialize(thresholds(materialize(sketch(keys), "quality-sketch")), "quality-fences")
    judged = judge(with_metrics(docs, text, m), fences, lang, source, m, v)
    return judged.where(F.col(f"{v}.kept")).select(*map(quoted, docs.columns))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    measured = materialize(with_metrics(docs, keep=["doc_id", "lang", "source"]), "quality-metrics")
    fences = materialize(thresholds(materialize(sketch(measured), "quality-sketch")), "quality-fences")
    judged = judge(measured, fences)
    counts = [F.col(f"metrics.{c}").alias(c) for c in _COUNTS[:5]]
    failed = F.col("verdict.base_failed").alias("base_failed")
    broken = F.array_join("verdict.broken", ",").alias("broken")
    return judged.select("doc_id", *counts, failed, F.col("verdict.kept").alias("kept"), broken)
