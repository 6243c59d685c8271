import itertools
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorwatch.llm import block_dedup, near_dedup
from sensorwatch.llm.components import components

from .conftest import ROWS, SCHEMA


def test_exact_groups(docs, empty):
    out = [r.asDict() for r in block_dedup.dedup(docs).collect()]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert len(out) == len(ROWS)
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is not None, i))
    sizes = sorted(len(g) for g in groups.values() for _ in g)
    assert sorted(r["group_size"] for r in out) == sizes
    assert sum(r["kept"] for r in out) == len(groups)
    assert {r["keep_id"] for r in out} == {min(g)[2] for g in groups.values()}
    assert block_dedup.dedup(empty).count() == 0


def test_blocks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(block_dedup, "BLOCK", 3)
    texts = ["", "abc", "abcabc", "abcabcabc", "abcabcabd", "abcabcabc", "abcabcabcabcabc", "abcabcabcabcabd", "x" * 100, "x" * 101, "x" * 100]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id: r.keep_id for r in block_dedup.dedup(df).collect()}
    assert kept == {i: texts.index(t) for i, t in enumerate(texts)}


def test_dropping_keeps_columns(docs, empty):
    out = block_dedup.drop_duplicates(docs)
    assert out.columns == docs.columns
    assert out.count() == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in ROWS})
    assert block_dedup.drop_duplicates(empty).count() == 0


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def _brute(rows):
    sets = [_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def test_near_groups(docs, empty):
    out = near_dedup.near_duplicates(docs).collect()
    assert sorted(((r._id, r.n_shingles, r.component_id) for r in out), key=str) == _brute(ROWS)
    assert near_dedup.near_duplicates(empty).count() == 0
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns


def test_near_groups_of_many_edits(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)  # blocks of blocks
    import random

    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(14)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r._id, r.n_shingles, r.component_id) for r in out), key=str) == _brute(rows)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)]
    out = components(spark.createDataFrame(links, "a long, b long"))
    groups = out.groupBy("label").agg(F.sort_array(F.collect_list("node")).alias("n")).collect()
    assert sorted(g.n for g in groups) == [list(range(61)), list(range(100, 150))]


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 10**6), min_size=1, max_size=80), st.integers(0, 40))
def test_sketch_fills_and_estimates(some, extra):
    import numpy as np

    a = np.array(sorted(some), dtype=np.uint64)
    b = np.unique(np.r_[a, np.arange(10**7, 10**7 + extra, dtype=np.uint64)])
    s = near_dedup.sketches([a, b])
    assert (s != near_dedup._FULL).all()
    assert abs((s[0] == s[1]).mean() - len(a) / len(b)) < 0.2


def test_hot_values_are_named_apart(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, block string")
    named = block_dedup.name_values(df, ["block"], 3000)
    got = named.groupBy("name").count().collect()
    assert len(got) == 2001 and max(r["count"] for r in got) == 1000


def test_schema_is_used():
    assert SCHEMA.startswith("doc_id")
