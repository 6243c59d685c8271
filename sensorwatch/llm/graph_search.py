"""Approximate nearest neighbours by largest inner product: a robust-pruned directed graph per shard.

Method: rows are dealt evenly into shards, and each shard is a graph of
directions (unit vectors), built by inserting all of them in batches, twice: a
greedy search from the shard's medoid proposes neighbours, relaxed distance
pruning keeps a diverse few of them, and reverse edges are pruned the same way.
Every query then runs a beam search by inner product in every shard (a stated
query set against all rows, in blocks of queries), from the medoid and the
longest vectors at once, so that lengths may differ at will. The beam's vectors
are scored in double precision, and the best of all shards are merged.

A shard measures its own recall when it is built, against brute force on some of
its vectors, and doubles its beam until that is high enough; a beam as long as
the shard finds all.

Contract: vectors that are null, empty, zero, or hold a null or non-finite entry
take no part, nor do rows with a null id or of another length than the commonest
one (of equally common ones, the longest). A query's own row is no candidate;
another row with its id or vector is. Equal vectors of a shard are one node, of
which the smallest ids are returned, so copies in any number are ranked exactly.
With fewer candidates than asked for all are returned; an empty table gives no
rows. Products beyond a double count as infinite. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import map_batches, materialize, quoted, read_table

#: Rows of a shard (its graph is built in one task: about 3 MB) and queries of a block.
SHARD_ROWS, BLOCK_ROWS = 2_048, 512
#: Out-edges of a node, spare ones that keep every node reachable, and the beams of building and searching.
DEGREE, SPARE, BUILD_BEAM, SEARCH_BEAM = 32, 8, 64, 96
#: Nodes expanded at once, points inserted at once, candidates compared in pruning, relaxation of each round of insertions.
EXPAND, INSERT, CANDIDATES, RELAX = 4, 256, 128, (1.0, 1.2)
#: Longest vectors that a search starts from; queries and recall (of DEGREE nearest) by which a shard chooses its beam.
ENTRIES, PROBES, RECALL = 128, 64, 0.98
#: Shards whose results are merged in one task (fewer if there are fewer than SLICES such groups).
SLICE, SLICES = 16, 8
NEIGHBOURS, QUERY_EVERY = 20, 20


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows as float32, divided by the largest entry of all (one factor, so inner products keep their order)."""
    return (x / (np.abs(x).max(initial=0.0) or 1.0)).astype(np.float32)


@dataclass
class Graph:
    """``edges[i]``: the nodes that ``i`` points to, -1 where there are fewer; a search starts at ``entries``."""

    points: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    def search(self, queries: np.ndarray, beam: int, visited: bool = False) -> np.ndarray:
        """Beam search of all queries in step: the ``beam`` best nodes of each, best first, -1 where there are fewer.

        With ``visited`` the best nodes among those expanded, as pruning wants them.
        """
        n, count = len(self.points), len(queries)
        lines = np.arange(count)[:, None]
        seen = np.zeros((count, n + 1), dtype=bool)  # the last column stands for no edge
        seen[:, n] = True
        ids = np.full((count, beam), n)
        sims = np.full((count, beam), -np.inf, dtype=np.float32)
        opened = np.zeros((count, beam), dtype=bool)
        starts = queries @ self.points[self.entries].T
        order = np.argsort(-starts, axis=1, kind="stable")[:, :beam]
        ids[:, : order.shape[1]] = self.entries[order]
        sims[:, : order.shape[1]] = np.take_along_axis(starts, order, 1)
        seen[:, self.entries] = True
        passed: list[np.ndarray] = []
        active = np.arange(count)
        while len(active):
            rows = lines[: len(active)]
            a_ids, a_sims, a_open = ids[active], sims[active], opened[active]
            waiting = ~a_open & (a_ids < n)
            first = np.argsort(~waiting, axis=1, kind="stable")[:, :EXPAND]  # the beam is sorted: best waiting ones
            chosen = waiting[rows, first]
            nodes = np.where(chosen, a_ids[rows, first], n)
            a_open[rows, first] |= chosen
            if visited:
                kept = np.full((count, EXPAND), n)
                kept[active] = nodes
                passed.append(kept)
            near = np.where(nodes[:, :, None] < n, self.edges[np.minimum(nodes, n - 1)], n).reshape(len(active), -1)
            near = np.sort(np.where(near < 0, n, near), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            fresh = ~seen[active[:, None], near]
            seen[active[:, None], near] = True
            at = np.flatnonzero(fresh)
            line, node = at // near.shape[1], near.ravel()[at]
            new = np.full(near.shape, -np.inf, dtype=np.float32)
            new.ravel()[at] = np.einsum("ij,ij->i", queries[active[line]], self.points[node])
            all_ids = np.concatenate([a_ids, np.where(fresh, near, n)], axis=1)
            all_sims = np.concatenate([a_sims, new], axis=1)
            all_open = np.concatenate([a_open, np.zeros(near.shape, dtype=bool)], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active], sims[active], opened[active] = all_ids[rows, best], all_sims[rows, best], all_open[rows, best]
            active = active[(~opened[active] & (ids[active] < n)).any(axis=1)]
        if visited:
            ids = np.concatenate(passed, axis=1)
        return np.where(ids < n, ids, -1)

    def prune(self, nodes: np.ndarray, candidates: np.ndarray, relax: float) -> np.ndarray:
        """Relaxed distance pruning: a diverse choice of at most DEGREE candidates (-1: none) for each node.

        The nearest candidate stays; one that is ``relax`` times nearer to it than
        to the node goes; and so on with the nearest of those left.
        """
        candidates = np.where(candidates == nodes[:, None], -1, np.sort(candidates, axis=1))
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        sims = np.einsum("ijk,ik->ij", self.points[candidates], self.points[nodes])
        sims[candidates < 0] = -np.inf
        order = np.argsort(-sims, axis=1, kind="stable")[:, :CANDIDATES]
        lines = np.arange(len(nodes))[:, None]
        candidates, sims = candidates[lines, order], sims[lines, order]
        vectors = self.points[candidates]
        apart = np.maximum(1 - vectors @ vectors.transpose(0, 2, 1), 0)
        own = np.maximum(1 - sims, 0)
        alive = candidates >= 0
        out = np.full((len(nodes), DEGREE + SPARE), -1)
        for k in range(DEGREE):
            pick = alive.argmax(axis=1)
            some = alive[lines[:, 0], pick]
            if not some.any():
                break
            out[some, k] = candidates[some, pick[some]]
            # squared distances: the relaxation counts twice
            alive &= (relax * relax) * apart[lines[:, 0], pick] > own
            alive[lines[:, 0], pick] = False
        return out

    def link_back(self, nodes: np.ndarray, relax: float) -> None:
        """An edge back to each of ``nodes`` from those it points to; lists that overflow are pruned."""
        source = np.repeat(nodes, DEGREE)
        target = self.edges[nodes, :DEGREE].ravel()
        source, target = source[target >= 0], target[target >= 0]
        known = (self.edges[target] == source[:, None]).any(axis=1)
        source, target = source[~known], target[~known]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        ends, start, number = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(start, number)
        for lo in range(0, len(ends), INSERT):
            part = ends[lo : lo + INSERT]
            inside = (target >= part[0]) & (target <= part[-1])
            more = np.full((len(part), int(number[lo : lo + INSERT].max())), -1)
            more[np.searchsorted(part, target[inside]), place[inside]] = source[inside]
            lists = np.concatenate([self.edges[part, :DEGREE], more], axis=1)
            room = (lists >= 0).sum(axis=1) <= DEGREE
            packed = np.take_along_axis(lists, np.argsort(lists < 0, axis=1, kind="stable"), axis=1)[:, :DEGREE]
            self.edges[part[room], :DEGREE] = packed[room]
            if not room.all():
                self.edges[part[~room]] = self.prune(part[~room], lists[~room], relax)

    def reached(self) -> np.ndarray:
        found = np.zeros(len(self.points), dtype=bool)
        found[self.entries] = True
        edge = self.entries
        while len(edge):
            near = np.unique(self.edges[edge])
            edge = near[(near >= 0) & ~found[near]]
            found[edge] = True
        return found

    def connect(self) -> None:
        """Spare edges to nodes that no path reaches, from the nearest reached node that has one left."""
        while not (found := self.reached()).all():
            lost = np.flatnonzero(~found)
            free = np.flatnonzero(found & (self.edges[:, DEGREE:] < 0).any(axis=1))
            near = self.points[lost] @ self.points[free].T
            at = near.max(axis=1).argmax()
            node = free[near[at].argmax()]
            self.edges[node, DEGREE + int((self.edges[node, DEGREE:] >= 0).sum())] = lost[at]


def build_graph(points: np.ndarray) -> Graph:
    """The graph of unit vectors (float32), the same for the same vectors in the same order."""
    n = len(points)
    edges = np.full((n, DEGREE + SPARE), -1)
    graph = Graph(points, edges, (points @ points.mean(axis=0)).argmax(keepdims=True))
    if n <= DEGREE + 1:  # every node points to all others
        for i in range(n):
            edges[i, : n - 1] = np.delete(np.arange(n), i)
        return graph
    rng = np.random.default_rng(n)
    edges[:, : DEGREE // 2] = (np.arange(n)[:, None] + rng.integers(1, n, (n, DEGREE // 2))) % n
    for relax in RELAX:
        order = rng.permutation(n)
        for lo in range(0, n, INSERT):
            nodes = order[lo : lo + INSERT]
            proposed = graph.search(points[nodes], BUILD_BEAM, visited=True)
            edges[nodes] = graph.prune(nodes, np.concatenate([proposed, edges[nodes, :DEGREE]], axis=1), relax)
            graph.link_back(nodes, relax)
    graph.connect()
    return graph


def searchable(vectors: np.ndarray) -> tuple[Graph, int]:
    """The graph of distinct vectors as it is searched by inner product, and the beam that it needs."""
    with np.errstate(over="ignore"):
        lengths = np.linalg.norm(vectors / (np.abs(vectors).max(initial=0.0) or 1.0), axis=1)
    unit = scaled(vectors / np.abs(vectors).max(axis=1, keepdims=True))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    graph = build_graph(unit)
    longest = np.argsort(-lengths, kind="stable")[:ENTRIES]
    graph = Graph(scaled(vectors), graph.edges, np.union1d(graph.entries, longest))
    n, beam = len(vectors), SEARCH_BEAM
    if n <= beam:
        return graph, beam
    probes = unit[np.random.default_rng(n).choice(n, min(n, PROBES), replace=False)]
    sims = probes @ graph.points.T
    best = np.argsort(-sims, axis=1, kind="stable")[:, :DEGREE]
    worst = np.take_along_axis(sims, best[:, -1:], 1)
    while beam < n:
        found = graph.search(probes, beam)
        hits = (np.take_along_axis(sims, np.maximum(found, 0), 1) >= worst) & (found >= 0)
        # equal values count as found
        if np.minimum(hits.sum(axis=1), DEGREE).mean() >= RECALL * DEGREE:
            break
        beam = min(2 * beam, n)
    return graph, beam


def vector_rows(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id``, ``row`` (a number of its own) and ``v`` (array of double) of the rows that take part, written once."""
    c = quoted(vector)
    finite = F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    some = F.exists(c, lambda e: e != 0)
    valid = table.select(quoted(vec_id).cast("long").alias("id"), c.cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & (F.size("v") > 0) & finite & some
    )
    widths = valid.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    width = widths.orderBy(F.desc("n"), F.desc("width")).first()  # one row
    valid = valid.where(F.size("v") == (width["width"] if width else 0))
    return materialize(valid.withColumn("row", F.monotonically_increasing_id()), "graph-rows")


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _gathered(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, row numbers and vectors of ``most`` rows at a time (all of the task without)."""
    held: list[pa.RecordBatch] = []

    def joined(rows: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(rows).combine_chunks()
        ids, numbers = (table.column(c).to_numpy() for c in ("id", "row"))
        return ids, numbers, np.concatenate([_matrix(c) for c in table.column("v").chunks])

    for batch in batches:
        while batch.num_rows:
            room = batch.num_rows if most is None else most - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if most is not None and sum(b.num_rows for b in held) == most:
                yield joined(held)
                held = []
    if held:
        yield joined(held)


def build_index(rows: DataFrame, neighbours: int = NEIGHBOURS) -> tuple[DataFrame, int]:
    """One row per shard: its distinct vectors, the smallest ids of each, and the edges between them; and the shards' number.

    Rows are dealt in turn to as many tasks as there are shards, so shards are equally large whatever the data.
    """
    shards = max(1, -(-rows.count() // SHARD_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, numbers, v in _gathered(batches, None):
            order = np.lexsort((numbers, ids))  # smallest ids first within equal vectors
            ids, numbers, v = ids[order], numbers[order], v[order]
            distinct, inverse, count = np.unique(v, axis=0, return_inverse=True, return_counts=True)
            by_node = np.argsort(inverse.ravel(), kind="stable")
            place = np.arange(len(v)) - np.repeat(np.cumsum(count) - count, count)
            few = by_node[place <= neighbours]  # one more than asked for: the query's own row may be among them
            graph, beam = searchable(distinct)
            row = {
                "shard": TaskContext.get().partitionId(),
                "width": v.shape[1],
                "ids": ids[few].tobytes(),
                "numbers": numbers[few].tobytes(),
                "copies": np.minimum(count, neighbours + 1).astype(np.int64).tobytes(),
                "vectors": distinct.tobytes(),
                "edges": graph.edges.astype(np.int32).tobytes(),
                "entries": graph.entries.astype(np.int64).tobytes(),
                "beam": beam,
            }
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    fields = [("shard", pa.int32()), ("width", pa.int32())]
    fields += [(c, pa.binary()) for c in ("ids", "numbers", "copies", "vectors", "edges", "entries")] + [("beam", pa.int32())]
    schema = pa.schema(fields)
    ddl = "shard int, width int, ids binary, numbers binary, copies binary, vectors binary, edges binary, entries binary, beam int"
    return materialize(map_batches(rows.repartition(shards), run, ddl), "graph-index"), shards


class Shard:
    """A shard of the index as it is searched."""

    def __init__(self, row: dict):
        def numbers(c: str, kind: str = "<i8") -> np.ndarray:
            return np.frombuffer(row[c], dtype=kind)

        self.vectors = numbers("vectors", "<f8").reshape(-1, row["width"])
        self.ids, self.numbers, self.copies = numbers("ids"), numbers("numbers"), numbers("copies")
        self.first = np.cumsum(self.copies) - self.copies
        edges = numbers("edges", "<i4").reshape(len(self.vectors), -1).astype(np.int64)
        self.graph, self.beam = Graph(scaled(self.vectors), edges, numbers("entries")), row["beam"]

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores (double, best first) and ids of each query's ``k`` nearest rows but its own; NaN where there are fewer."""
        with np.errstate(over="ignore", invalid="ignore"):
            small = queries / np.abs(queries).max(axis=1, keepdims=True)
            nodes = self.graph.search(small.astype(np.float32), max(self.beam, 2 * k))
            score = np.einsum("ijk,ik->ij", self.vectors[nodes], queries)
        score = np.where(np.isnan(score), np.inf, score)  # opposite infinities
        score[nodes < 0] = -np.inf
        # the k + 1 best nodes and all that tie with the last of them
        last = -np.sort(-score, axis=1)[:, k : k + 1]
        line, column = np.nonzero((score >= last) & (nodes >= 0))
        node = nodes[line, column]
        count = self.copies[node]
        line, value = np.repeat(line, count), np.repeat(score[line, column], count)
        at = np.repeat(self.first[node] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        other = self.numbers[at] != own[line]
        line, value, ids = line[other], value[other], self.ids[at[other]]
        order = np.lexsort((ids, -value, line))
        line, value, ids = line[order], value[order], ids[order]
        place = np.arange(len(line)) - np.searchsorted(line, line)
        line, value, ids, place = (z[place < k] for z in (line, value, ids, place))
        scores = np.full((len(queries), k), np.nan)
        found = np.zeros((len(queries), k), dtype=np.int64)
        scores[line, place], found[line, place] = value, ids
        return scores, found


def merge_best(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of two lists of scores (NaN: none) and ids per query, ties to the smaller id."""
    scores, ids = (np.concatenate(z, axis=1) for z in zip(a, b, strict=True))
    order = np.lexsort((ids, -scores, np.isnan(scores)), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def query_blocks(queries: DataFrame) -> DataFrame:
    """The query rows (``id, row, v``) packed into rows of up to BLOCK_ROWS of them, written once."""
    parts = max(1, -(-queries.count() // BLOCK_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, numbers, v in _gathered(batches, BLOCK_ROWS):
            packed = [pa.array([z.tobytes()], pa.binary()) for z in (ids, numbers, np.ascontiguousarray(v))]
            yield pa.RecordBatch.from_arrays(packed, names=["q_ids", "q_numbers", "q_vectors"])

    blocks = map_batches(queries.repartition(parts), run, "q_ids binary, q_numbers binary, q_vectors binary")
    return materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "graph-queries")


def search_index(index: DataFrame, shards: int, blocks: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, query_row, rank, id, score``: every block of queries meets every shard, results are merged per query.

    Shards are dealt into slices; a block meets a slice's shards one behind the
    other in one task, which keeps only the best ``k`` of each query.
    """
    slices = max(-(-shards // SLICE), min(shards, SLICES))
    dealt = index.withColumn("slice", F.pmod("shard", F.lit(slices)))
    asked = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    # the shards of a slice are the join's inner rows, so they come together for each block
    pairs = asked.join(dealt.hint("merge"), "slice").drop("slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_number, shard, block, best, asked_now = None, None, None, None, None

        def result() -> pa.RecordBatch:
            scores, ids = best
            lists = np.r_[0, np.cumsum((~np.isnan(scores)).sum(axis=1))].astype(np.int32)
            has = ~np.isnan(scores)
            columns = [
                pa.array(asked_now[0]),
                pa.array(asked_now[1]),
                pa.ListArray.from_arrays(pa.array(lists), pa.array(ids[has])),
                pa.ListArray.from_arrays(pa.array(lists), pa.array(scores[has])),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["query_id", "query_row", "ids", "scores"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] != block:
                    if best is not None:
                        yield result()
                    block, best = row["block"], None
                    ids, numbers = (np.frombuffer(row[c], dtype="<i8") for c in ("q_ids", "q_numbers"))
                    asked_now = ids, numbers, np.frombuffer(row["q_vectors"], dtype="<f8").reshape(len(ids), -1)
                if row["shard"] != shard_number:
                    shard_number, shard = row["shard"], Shard(row)
                found = shard.nearest(asked_now[2], asked_now[1], k)
                best = found if best is None else merge_best(best, found, k)
        if best is not None:
            yield result()

    lists = map_batches(pairs, run, "query_id long, query_row long, ids array<long>, scores array<double>")
    rows = lists.select("query_id", "query_row", F.explode(F.arrays_zip("ids", "scores")).alias("hit"))
    rows = rows.select("query_id", "query_row", F.col("hit.ids").alias("id"), F.col("hit.scores").alias("score"))
    # Spark keeps the first k of each query before the shuffle, too
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_rows(
    table: DataFrame, k: int = NEIGHBOURS, every: int = QUERY_EVERY, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows of each row whose id is divisible by ``every``."""
    rows = vector_rows(table, vec_id, vector)
    index, shards = build_index(rows, k)
    return search_index(index, shards, query_blocks(rows.where(F.col("id") % every == 0)), k)


def op13_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all ``embeddings`` for each row whose id is divisible by 20."""
    found = nearest_rows(read_table(spark, sf_dir, "embeddings"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
