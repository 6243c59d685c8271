"""Whitening of embeddings by shifted CholeskyQR.

Method: rows are centred exactly (integers), and Gram passes over the distinct
rows make them orthonormal step by step: each pass sums ``Q^T Q`` over all
tasks, factors it (the first time with a shift, later only as far as the
factorization needs one), and divides the rows by the factor with a triangular
solve. The composed factor ``R`` has the singular values and right singular
vectors of the centred rows; its SVD gives the components. No row is kept
between passes but the integers themselves.

Entries are read as ``floor(64 c) + 1,000,000``. The fit list holds each
distinct row of integers once; every covariance is over it, with divisor ``n``.

Contract: rows whose vector is null, empty, or holds a null or non-finite entry
are left out, as are rows of another length than the commonest one (of equally
common ones, the longest); ``64 c`` ends at +-2^40; a null id is an id as any
other and repeated rows are all returned; ``deviation`` beyond a long is null.
Components without variance (constant or dependent dimensions, a single distinct
row) do not exist: there are as many as the numerical rank, 16 at most; without
any, or without rows, the result is empty. Of the two signs of a component, the
one with a positive largest entry is taken. Only the id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, quoted, read_table

SCALE, OFFSET, LIMIT = 64, 1_000_000, 1 << 40
COMPONENTS = 16
#: Gram passes at most; three are the rule, more only for dependent dimensions of very different size.
PASSES = 8
UNIT = 2.0**-53


def integer_rows(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``x`` (array of long) of the rows that take part."""
    c = quoted(vector)
    finite = F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    valid = table.select(quoted(vec_id).alias("id"), c.alias("v")).where((F.size(c) > 0) & finite)
    widths = valid.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    width = widths.orderBy(F.desc("n"), F.desc("width")).first()  # one row
    most = F.lit(float(LIMIT))
    whole = F.transform("v", lambda e: F.floor(F.least(most, F.greatest(-most, e.cast("double") * SCALE))) + OFFSET)
    return valid.where(F.size("v") == (width["width"] if width else 0)).select("id", whole.alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Centre:
    """Rows and sums per dimension of the fit list (exact, any size)."""

    n: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: as long where that cannot overflow, else as Python integers."""
        bound = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        if bound < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in double precision, column by column in memory."""
        return np.asfortranarray(self.deviations(x).astype(np.float64) / self.n)

    def squares(self, x: np.ndarray) -> list[int | None]:
        """Exact squared length of ``n x - S``; None beyond a long."""
        d = self.deviations(x)
        most = int(np.abs(d).max(initial=0))
        if most * most * max(d.shape[1], 1) < 1 << 63:
            return (d * d).sum(axis=1).astype(np.int64).tolist()
        whole = (d.astype(object) ** 2).sum(axis=1).tolist()
        return [int(v) if v < 1 << 63 else None for v in whole]


def divide(rows: np.ndarray, factors: Sequence[np.ndarray]) -> np.ndarray:
    """``rows R1^-1 R2^-1 ...``: a triangular solve per upper factor, column by column."""
    for r in factors:
        out = np.empty_like(rows, order="F")
        for j in range(rows.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def centre_of(fit: DataFrame, width: int) -> Centre:
    """Counts and exact sums: longs within a batch (2^40 times at most 2,000 rows), decimals across."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sums = np.r_[batch.num_rows, _matrix(batch.column("x")).sum(axis=0)]
                columns = [pa.array(np.arange(-1, width, dtype=np.int32)), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, names=["i", "s"])

    parts = map_batches(fit.select("x"), run, "i int, s long")
    found = {r["i"]: int(r["s"]) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return Centre(found.get(-1, 0), tuple(found.get(i, 0) for i in range(width)))


def gram(fit: DataFrame, centre: Centre, factors: Sequence[np.ndarray], project: np.ndarray | None = None) -> np.ndarray:
    """``Q^T Q`` of the fit list's centred rows, divided by ``factors`` and projected on the columns of ``project``.

    One matrix a task, summed by Spark entry by entry; the driver gets width x width numbers.
    """
    width = project.shape[1] if project is not None else len(centre.sums)
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                q = divide(centre.rows(_matrix(batch.column("x"))), factors)
                q = q if project is None else q @ project
                total += q.T @ q
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "g"])

    parts = map_batches(fit.select("x"), run, "i int, j int, g double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["g"]
    return out


def factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of ``g`` plus the smallest shift, from ``shift`` on, with which there is one."""
    size = float(np.linalg.norm(g, 2)) or 1.0
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(16 * shift, 4 * len(g) * UNIT * size)


@dataclass(frozen=True)
class Whitening:
    """Fitted components: ``vectors[:, k]`` and ``variances[k]``, by falling variance; ``total`` is the covariance's trace."""

    centre: Centre
    vectors: np.ndarray
    variances: np.ndarray
    total: float
    passes: int

    def projection(self, most: int) -> np.ndarray:
        return self.vectors[:, :most] / np.sqrt(self.variances[:most])


def fit_whitening(fit: DataFrame, width: int) -> Whitening:
    """Shifted CholeskyQR over the distinct rows ``x`` (written already), then the SVD of the composed factor."""
    centre = centre_of(fit, width)
    n = centre.n
    none = Whitening(centre, np.zeros((width, 0)), np.zeros(0), 0.0, 0)
    if n < 2:
        return none
    g = gram(fit, centre, [])
    total = float(np.trace(g)) / n
    if total == 0:
        return none
    # a constant dimension is exactly zero in all rows, and so in all components
    live = np.flatnonzero(np.diag(g) > 0)
    factors: list[np.ndarray] = []
    r = np.eye(width)
    for done in range(1, PASSES + 1):
        first = 11 * (n * len(live) + len(live) * (len(live) + 1)) * UNIT * float(np.linalg.norm(g, 2))
        step = np.eye(width)
        step[np.ix_(live, live)] = factor(g[np.ix_(live, live)], first if done == 1 else 0.0)
        factors.append(step)
        r = step @ r
        g = gram(fit, centre, factors)
        # orthonormal, or (with dependent dimensions) a projection on the rows' space
        if np.abs(g @ g - g).max() < 1e-13 * width:
            break
    u, s, vt = np.linalg.svd(r[np.ix_(live, live)])
    filled = np.einsum("ik,ij,jk->k", u, g[np.ix_(live, live)], u)  # 1 where the component has rows behind it, else 0
    keep = (filled > 0.5) & (s > s[0] * len(live) * 2 * UNIT)
    variances = (s**2 * filled / n)[keep]
    order = np.argsort(-variances, kind="stable")
    vectors = np.zeros((width, len(order)))
    vectors[live] = vt[keep].T[:, order]
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[top, np.arange(len(order))])
    return Whitening(centre, vectors, variances[order], total, done)


def identity_error(fit: DataFrame, model: Whitening, most: int = COMPONENTS) -> float:
    """Largest entry of the whitened fit list's covariance less the identity."""
    p = model.projection(most)
    return float(np.abs(gram(fit, model.centre, [], p) / model.centre.n - np.eye(p.shape[1])).max(initial=0.0))


def whiten(
    table: DataFrame, most: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, Whitening | None]:
    """One row per row that takes part: ``id``, exact squared ``deviation`` and the array ``whitened``; and the model."""
    rows = integer_rows(table, vec_id, vector)
    kind = rows.schema["id"].dataType.simpleString()
    # equal rows meet once per task before they are shuffled, so a group of copies is never large
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    one = fit.first()
    schema = f"id {kind}, deviation long, whitened array<double>"
    if one is None:
        return table.sparkSession.createDataFrame([], schema), None
    model = fit_whitening(fit, len(one["x"]))
    p = model.projection(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            white = model.centre.rows(x) @ p
            ends = np.arange(len(x) + 1, dtype=np.int32) * p.shape[1]
            whitened = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(white).ravel()))
            columns = [batch.column("id"), pa.array(model.centre.squares(x), pa.int64()), whitened]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "deviation", "whitened"])

    out = map_batches(rows, run, schema)
    out = out.withMetadata("whitened", {"identity_error": identity_error(fit, model, most)})
    return out, model


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all ``embeddings``, a row per vector and component."""
    rows, model = whiten(read_table(spark, sf_dir, "embeddings"))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(v / model.total)) for v in model.variances[:COMPONENTS]]).cast("array<double>")
    error = rows.schema["whitened"].metadata["identity_error"]
    return rows.select("id", "deviation", F.posexplode("whitened")).select(
        F.col("id").alias("vec_id"),
        (F.col("pos") + 1).alias("component"),
        F.lit(model.centre.n).cast("long").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        shares[F.col("pos")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
