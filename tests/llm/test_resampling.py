"""Importance resampling against word-by-word counting."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from sensorwatch.llm import resampling as R

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    return words, Counter(zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def _brute(rows, target):
    docs = [(i, *_features(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, c in docs:
        s.update(c)
    for text in target:
        t.update(_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    out = []
    for i, words, c in docs:
        n = sum(c.values())
        weight = sum(gain[b] * k for b, k in c.items()) // n if n else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: 25 * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def _run(docs, target):
    out = R.resample(docs, target).select("id", "n_features", "weight", "score", "rank")
    return sorted((tuple(r) for r in out.collect()), key=str)


ODD = [
    "Straße " * 30, "漢" * 70 + " " + "字" * 90 + " x", "a", "a b", "\x00a\x00b", "é" * 65 + " é", "A-B_c{d}e~f`g", "the cat " * 5000,
    "one " + "z" * 64 + " " + "y" * 65 + " two",
]


def test_features_equal_brute_force():
    texts = ODD + ["", " \t ", "tail 9"]
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(b) for b in raw])]
    n_words, doc, bucket = R.FeatureBuckets().features(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    planes, n = R.to_planes(len(texts), doc, bucket)
    rows = planes.view("<u8").reshape(-1, R.PLANE)
    at = 0
    for i, t in enumerate(texts):
        words, want = _features(t)
        assert n_words[i] == len(words)
        got = sum((np.unpackbits(rows[at + k].view(np.uint8), bitorder="little").astype(int) << k for k in range(n[i])), np.zeros(R.PLANE * 64, int))
        assert {b: int(got[b]) for b in np.flatnonzero(got)} == dict(want)
        at += n[i]


def test_planes_add_up():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 40, (77, R.PLANE * 64)) * (rng.random((77, R.PLANE * 64)) < 0.2)
    by_bit = {i: np.stack([np.packbits((c >> i) & 1 == 1, bitorder="little").view("<u8") for c in counts]) for i in range(6)}
    total = sum(np.unpackbits(p.view(np.uint8), bitorder="little").astype(int) << i for i, p in R.add_planes(by_bit).items())
    assert (total == counts.sum(axis=0)).all()


def test_gain_planes_are_signed():
    gains = [0, 1, -1, 8191, -8192, 37, -500]
    planes, worth = R.gain_planes(gains)
    bits = np.stack([np.unpackbits(p.view(np.uint8), bitorder="little") for p in planes])
    assert (worth @ bits)[: len(gains)].tolist() == gains


def test_awkward_rows(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = ["the cat sat on the mat", None, "", "old town hall"]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert _run(docs, items) == _brute(rows, target)


def test_ties_repeats_and_long_words(spark):
    base = [(i % 7, f"w{i % 3} " * 25 + ODD[i % len(ODD)]) for i in range(300)]
    rows = base + [(11, "same words here again " * 6)] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([("w1 w1 same words",)], "text string")
    got, want = _run(df, items), _brute(rows, ["w1 w1 same words"])
    drop = lambda t: sorted((r[:4] for r in t), key=str)
    assert drop(got) == drop(want)
    ranks = lambda t: sorted((r[4], r[3], r[0]) for r in t if r[4])
    assert ranks(got) == ranks(want) and len(ranks(got)) == 125


def test_empty_tables_and_draw(spark, docs, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    assert _run(empty, items) == []
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _run(docs, items) == _brute(rows, [])
    result = R.resample(docs, items, percent=100, min_words=5)
    kept = R.drawn_documents(docs, result)
    assert kept.columns == docs.columns and kept.count() == len([1 for i, t in rows if len(_features(t)[0]) >= 5])
