"""Whitening and graph search against numpy on all rows."""

import math

import numpy as np
import pytest

from sensorwatch.llm import graph_search as G
from sensorwatch.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, id string, v long, x string"
BAD = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [1.0, math.nan, 0.0, 0.0, 0.0, 0.0], [math.inf] * 6, [1.0, 2.0]]


def _table(spark, vectors, ids=None, parts=3):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if e is None else float(e) for e in v], "x", None, "y") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def _whitened(spark, table, tmp_path):
    rows, model = W.whiten(table)
    return {(r.id, r.deviation): np.array(r.whitened) for r in rows.collect()}, model, rows


def _brute(vectors):
    x = np.floor(64 * np.array(vectors, dtype=float)) + 1e6
    u = np.unique(x, axis=0)
    mean = np.array([math.fsum(c) for c in u.T]) / len(u)
    e, v = np.linalg.eigh((u - mean).T @ (u - mean) / len(u))
    return x, u, mean, e[::-1], v[:, ::-1]


def test_whitening_equals_eigenvectors(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 20)) @ rng.normal(size=(20, 20))
    vectors = np.concatenate([vectors, vectors[:1].repeat(150, axis=0)])  # copies count once
    rows, model = W.whiten(_table(spark, vectors))
    x, u, mean, e, v = _brute(vectors)
    assert model.centre.n == len(u)
    got = {r.id: r for r in rows.collect()}
    want = (x - mean) @ v[:, :16] / np.sqrt(e[:16])
    have = np.array([got[i].whitened for i in range(len(vectors))])
    assert np.abs(have * np.sign((have * want).sum(axis=0)) - want).max() < 1e-8
    assert np.abs(model.variances[:16] / model.total / (e / e.sum())[:16] - 1).max() < 1e-10
    sums = u.astype(int).sum(axis=0)
    assert [got[i].deviation for i in range(len(vectors))] == ((len(u) * x.astype(int) - sums) ** 2).sum(axis=1).tolist()
    assert rows.schema["whitened"].metadata["identity_error"] < 1e-9


def test_whitening_of_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(6)
    b = rng.integers(-500, 500, size=(200, 4)) / 64
    vectors = np.c_[b, b[:, 0] + b[:, 1], np.full(200, 3.0), b[:, 2] * 4096]
    rows, model = W.whiten(_table(spark, vectors))
    assert len(model.variances) == 4 and all(len(r.whitened) == 4 for r in rows.collect())
    assert rows.schema["whitened"].metadata["identity_error"] < 1e-4
    _, _, _, e, _ = _brute(vectors)
    assert np.allclose(model.variances, e[:4], rtol=1e-8)


def test_whitening_with_few_rows(spark):
    rows, model = W.whiten(_table(spark, [[1, 0, 0], [0, 1, 0], [0, 0, 1], [1, 0, 0]], [None, 1, 2, 1]))
    assert len(model.variances) == 2 and rows.count() == 4
    for vectors in ([[1, 2, 3]], [[1, 2, 3]] * 4):
        rows, model = W.whiten(_table(spark, vectors))
        assert len(model.variances) == 0 and all(r.whitened == [] and r.deviation == 0 for r in rows.collect())


def test_whitening_leaves_out_what_is_no_vector(spark):
    rng = np.random.default_rng(7)
    good = rng.normal(size=(30, 6)).tolist()
    rows, model = W.whiten(_table(spark, good + BAD))
    assert {r.id for r in rows.collect()} == set(range(30)) and model.centre.n == 30
    for none in ([], [None, []]):
        rows, model = W.whiten(_table(spark, none))
        assert model is None and rows.count() == 0


def test_whitening_of_huge_entries(spark):
    rows, model = W.whiten(_table(spark, [[1e300, 1.0], [-1e300, 2.0], [5.0, -3.0]]))
    got = {r.id: r for r in rows.collect()}
    assert got[0].deviation is None and len(model.variances) >= 1  # beyond a long
    assert all(math.isfinite(w) for r in got.values() for w in r.whitened)


def _nearest(ids, vectors, q, k=20):
    with np.errstate(over="ignore"):
        s = vectors @ vectors[q]
    order = [i for i in np.lexsort((ids, -s)) if i != q][:k]
    return [(int(ids[i]), float(s[i])) for i in order]


def _recall(spark, vectors, ids=None, k=20):
    vectors = np.array(vectors, dtype=float)
    ids = np.arange(len(vectors)) if ids is None else np.array(ids)
    found = {}
    for r in G.nearest_rows(_table(spark, vectors, ids.tolist()), k).collect():
        found.setdefault((r.query_id, r.query_row), []).append((r["rank"], r["id"], r.score))
    hits = []
    asked = np.flatnonzero(ids % 20 == 0)
    assert len(found) == len(asked)
    for q in asked:
        want = _nearest(ids, vectors, q, k)
        scores = dict(want)
        for (query, _), got in found.items():
            if query == ids[q]:
                got.sort()
                assert [g[0] for g in got] == list(range(1, len(want) + 1))
                assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
                for _, i, s in got:
                    if i in scores:
                        assert s == pytest.approx(scores[i], rel=1e-12)
                hits.append(len({g[1] for g in got} & set(scores)) / len(scores))
    return float(np.mean(hits))


def test_recall_on_spheres_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(G, "SHARD_ROWS", 700)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 48))
    assert _recall(spark, x / np.linalg.norm(x, axis=1, keepdims=True)) >= 0.97
    assert _recall(spark, x * np.exp(rng.normal(size=(3000, 1)))) >= 0.97  # products, not angles
    clusters = rng.normal(size=(40, 48))[rng.integers(0, 40, 3000)] * 3 + x * 0.1
    assert _recall(spark, clusters) >= 0.97


def test_copies_are_ranked_by_id(spark, monkeypatch):
    monkeypatch.setattr(G, "SHARD_ROWS", 500)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 16))
    x[:900] = x[0]  # one vector holds over a third of all rows
    found = G.nearest_rows(_table(spark, x)).where("query_id = 40").orderBy("rank").collect()
    want = _nearest(np.arange(1500), x, 40)
    assert [(r["id"], pytest.approx(r.score)) for r in found] == want
    assert [w[0] for w in want] == sorted(w[0] for w in want)


def test_few_candidates_and_odd_rows(spark):
    vectors = [[3, 0, 1, 0, 0, 0], [0, 2, 0, 0, 1, 0], [1e200, 0, 0, 0, 0, 1], [1, 1, 1, 1, 1, 1]] + BAD + [[0.0] * 6]
    got = [tuple(r) for r in G.nearest_rows(_table(spark, vectors)).select("query_id", "rank", "id", "score").orderBy("rank").collect()]
    assert [(q, r, i) for q, r, i, _ in got] == [(0, 1, 2), (0, 2, 3), (0, 3, 1)]
    assert got[0][3] == pytest.approx(3e200) and got[2][3] == 0.0
    same = G.nearest_rows(_table(spark, [[1, 0, 0, 0, 0, 0]] * 2 + [[1, 1, 0, 0, 0, 0], [9, 9, 9, 9, 9, 9]], [20, 20, 5, None])).collect()
    assert sorted((r.query_id, r["rank"], r["id"]) for r in same) == [(20, 1, 5), (20, 1, 5), (20, 2, 20), (20, 2, 20)]
    assert G.nearest_rows(_table(spark, [])).count() == 0
    assert G.nearest_rows(_table(spark, [[1, 1, 1, 1, 1, 1]])).count() == 0


def test_every_node_is_reached():
    rng = np.random.default_rng(10)
    line = np.arange(1, 601)[:, None] * np.ones((1, 8))  # one direction
    far = np.concatenate([rng.normal(size=(600, 8)) * 0.01, rng.normal(size=(5, 8)) * 100, line])
    graph, beam = G.searchable(far)
    assert graph.reached().all() and (graph.edges < len(far)).all()
    queries = rng.normal(size=(100, 8)).astype(np.float32)
    found, best = graph.search(queries, beam)[:, :20], np.argsort(-(queries @ far.T), axis=1)[:, :20]
    assert np.mean([len(set(f) & set(b)) / 20 for f, b in zip(found, best, strict=True)]) >= 0.95
