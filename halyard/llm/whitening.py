"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors are whole numbers x = floor(64 * c) + 1000000. Sums and products are
exact integers: tasks add up what they read, a second level of a fixed number
of tasks adds those up, and the driver gets that many small matrices, whatever
the size of the table. Products are of numbers less the whole part of their
mean; its fraction is taken out afterwards, exactly, so nothing cancels.

The scatter matrix A has as many rows as a vector has components. Its pivoted
Cholesky factor L (A = L L^T) shows its rank; rotations of pairs of L's columns
until all are orthogonal leave columns whose squared norms are A's eigenvalues
and whose directions are its eigenvectors. A itself is never diagonalised, so
small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import arrow_task, discard, durable
from halyard.llm.vectors import as_longs, longest, matrix, products, whole_vectors

#: What a whole component is raised by, and components of the result at most.
OFFSET, COMPONENTS = 1_000_000, 16
#: Tasks that add up what all others have summed.
MERGERS = 16


@dataclass(frozen=True)
class Whitener:
    """What whitening needs of a fit list: n vectors, their sums, and unit components (rows) by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def whole_mean(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """n times what the mean has beyond its whole part."""
        return [s % self.n for s in self.sums]

    def project(self, x: np.ndarray) -> np.ndarray:
        y = (x - np.array(self.whole_mean, np.int64)).astype(np.float64) - np.array([r / self.n for r in self.rest])
        return y @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - sums)^2."""
        y = x - np.array(self.whole_mean, np.int64)
        most = max(int(np.abs(y).max(initial=0)) * self.n, self.n)
        kind = np.int64 if len(self.sums) * 4 * most * most < 1 << 63 else object
        d = y.astype(kind) * self.n - np.array(self.rest, kind)
        return as_longs((d * d).sum(axis=1)) if len(self.sums) else np.zeros(len(x), np.int64)


def added_up(df: DataFrame, column: str, width: int, sums_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of sums_of(the vectors of a batch), an array of exact integers of one length.

    Each task sends one row, MERGERS tasks add those up; the numbers travel as
    text, so they may have any length.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            part = sums_of(matrix(b.column(0), width)).astype(object)
            total = part if total is None else total + part
        if total is not None:
            yield sent(total)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for row in b.column(0).to_pylist():
                part = np.array([int(x) for x in row], object)
                total = part if total is None else total + part
        if total is not None:
            yield sent(total)

    def sent(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([[str(x) for x in total]], pa.list_(pa.string()))], names=["sums"])

    parts = arrow_task(arrow_task(df.select(column), partial, "sums array<string>").repartition(MERGERS), merged, "sums array<string>")
    rows = [np.array([int(x) for x in r[0]], object) for r in parts.collect()]
    return sum(rows[1:], rows[0]) if rows else None


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L and the order of rows p with a[p][:, p] = L L^T: each step takes the largest diagonal that is left, and ends where none is left but rounding."""
    a, size = a.copy(), len(a)
    order, factor = np.arange(size), np.zeros((size, size))
    least = np.finfo(float).eps * size * a.diagonal().max(initial=0)
    for k in range(size):
        at = k + int(np.argmax(a.diagonal()[k:]))
        if a[at, at] <= least:
            return factor[:, :k], order
        for m in (a, a.T, factor):
            m[[k, at]] = m[[at, k]]
        order[[k, at]] = order[[at, k]]
        factor[k:, k] = a[k:, k] / np.sqrt(a[k, k])
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated in pairs until all are orthogonal.

    A sweep meets every pair once, in rounds of disjoint pairs that are rotated
    together; it ends when a sweep finds no pair whose angle matters.
    """
    u = factor.copy()
    count = u.shape[1]
    if count < 2:
        return u
    ring = list(range(count)) + [None] * (count % 2)
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1]) if a is not None and b is not None]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            left, right = (np.array(x) for x in zip(*pairs))
            p, q = u[:, left], u[:, right]
            pp, qq, pq = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            matters = np.abs(pq) > 1e-15 * np.sqrt(pp * qq)
            if not matters.any():
                continue
            turned = True
            left, right, p, q, pp, qq, pq = left[matters], right[matters], p[:, matters], q[:, matters], pp[matters], qq[matters], pq[matters]
            zeta = (qq - pp) / (2 * pq)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            u[:, left], u[:, right] = c * p - c * t * q, c * t * p + c * q
        if not turned:
            break
    return u


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (rows) of a scatter matrix by falling eigenvalue, and the eigenvalues; as many as its rank."""
    factor, order = pivoted_cholesky(scatter)
    rotated = one_sided_jacobi(factor)
    norms = (rotated * rotated).sum(0)
    by_size = np.argsort(-norms, kind="stable")
    columns = np.empty_like(rotated)
    columns[order] = rotated
    return (columns[:, by_size] / np.sqrt(norms[by_size])).T, norms[by_size]


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of a fit list, a table of `whole` vectors (raised by OFFSET) that are all different; None of no rows.

    Two passes: sums, then products of what is left beyond the whole part of the mean.
    """
    sums = added_up(distinct, "whole", width, lambda x: np.array([len(x), *[sum(c.tolist()) for c in x.T]], object))
    if sums is None or not sums[0]:
        return None
    n, sums = sums[0], list(sums[1:])
    mean = np.array([s // n for s in sums], np.int64)
    grams = added_up(distinct, "whole", width, lambda x: products((x - mean).T, x - mean).ravel())
    rest = [s % n for s in sums]
    # n times the scatter: n * sum(y y^T) - rest rest^T, exact, rounded once
    gram = grams.reshape(width, width)
    scatter = np.array([[float(Fraction(n * gram[i, j] - rest[i] * rest[j], n * n)) for j in range(width)] for i in range(width)]).reshape(width, width)
    vectors, values = principal(scatter)
    return Whitener(n, sums, vectors[:components], values[:components], float(np.trace(scatter)))


def identity_error(distinct: DataFrame, width: int, model: Whitener) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity.

    Tasks send count, mean and centred products of their rows; they are merged
    by the update of Chan, Golub and LeVeque, which centres before it multiplies.
    """
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def merge(a: tuple | None, b: tuple) -> tuple:
        if a is None:
            return b
        n, d = a[0] + b[0], b[1] - a[1]
        return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)

    def sent(t: tuple | None) -> Iterator[pa.RecordBatch]:
        if t is not None:
            yield pa.RecordBatch.from_arrays([pa.array([t[0]], pa.int64()), pa.array([t[1].tolist()]), pa.array([t[2].ravel().tolist()])], names=["n", "mean", "products"])

    def received(rows: Iterator) -> Iterator[tuple]:
        for n, mean, both in rows:
            yield n, np.array(mean), np.array(both).reshape(k, k)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                w = model.project(matrix(b.column(0), width))
                mean = w.mean(0)
                total = merge(total, (len(w), mean, (w - mean).T @ (w - mean)))
        yield from sent(total)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for t in received(zip(*[b.column(i).to_pylist() for i in range(3)])):
                total = merge(total, t)
        yield from sent(total)

    schema, total = "n long, mean array<double>, products array<double>", None
    for t in received(arrow_task(arrow_task(distinct.select("whole"), partial, schema).repartition(MERGERS), merged, schema).collect()):
        total = merge(total, t)
    return float(np.abs(total[2] / total[0] - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable vector: vec_id, n, deviation, whitened (array), explained (array), identity_error.

    The fit list holds each different vector once, so copies, however many,
    weigh as one. Rows whose vector is null or holds a null or non-finite entry
    are left out; repeated rows and ids stay, a null id is an id like any other.
    Shorter vectors count as continued by zeros, empty ones too; entries beyond
    2^60 in size count as 2^60. There are as many components as asked for, or
    as the scatter's rank, so none where all vectors are equal. deviation stops
    at the largest long. No rows, no rows. Columns beside the two named ones
    are not read.
    """
    spark = embeddings.sparkSession
    raised = whole_vectors(embeddings, id_col, vector_col).withColumn("whole", F.transform("whole", lambda x: x + OFFSET))
    width = longest(raised)
    # what is shorter is continued here, so that equal vectors are equal as arrays
    raised = raised.withColumn("whole", F.when(F.size("whole") < width, F.concat("whole", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("whole")))).otherwise(F.col("whole")))
    distinct, path = durable(raised.select("whole").distinct(), "whitening-fit")
    model = fit(distinct, width, components)
    schema = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if model is None:
        discard(spark, path)
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, width, model)
    discard(spark, path)
    explained = (model.eigenvalues / model.trace).tolist() if model.trace else []

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("whole"), width)
            w, n = model.project(x), b.num_rows
            lists = lambda flat, each: pa.ListArray.from_arrays(pa.array(np.arange(0, n * each + 1, each) if each else np.zeros(n + 1), pa.int32()), pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(np.full(n, model.n), pa.int64()), pa.array(model.deviation(x), pa.int64()), lists(w.ravel(), w.shape[1]), lists(np.tile(explained, n), len(explained)), pa.array(np.full(n, error))],
                names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return arrow_task(raised, rows, schema)
