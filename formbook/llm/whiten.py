"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries become integers (floor of ``SCALE`` times the entry), so sums, centring and deviations are exact. The fit list
holds each distinct vector once. Its scatter is factored as L L' with pivoting; Jacobi rotations make the columns of L
orthogonal, and then a column's squared norm is an eigenvalue of the scatter and the column, normalised, its component.
Working on the factor keeps the small eigenvalues to their own precision, as a decomposition of the scatter itself would not.

Scale: vectors are shuffled once, to find the distinct ones (a vector that a third of the rows share is combined before);
everything else is a map with sums of dims x dims numbers, added by Spark. The driver holds the scatter of dims x dims
numbers and factors it, whatever the number of rows; the projection of dims x ``most`` numbers is sent to the tasks.

Edge cases: rows whose vector is null, empty, of another length than most (ties: the longer), or holds null, non-finite or
too large entries (2**53 and more after scaling) take no part; a null vec_id is kept; repeated rows are rows of their own and count once
in the fit list; components whose eigenvalue is zero to working precision have no rows, so fewer than ``most`` come where the vectors
span less, and none where there is one distinct vector or none; extra columns are not read. ``deviation`` is null where it exceeds a long;
``deviation_exact`` holds it to 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formbook.llm.common import materialize, ship

#: Fixed values of the contract: entries are floored to multiples of 1/256; components of a row.
SCALE, MOST = 256, 4
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
#: Sums of longs are kept in two parts, so that none overflows.
_PART = 1 << 26


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L', one column for each pivot that is not zero to working precision; rows in the order of ``a``."""
    d = len(a)
    rest = np.diag(a).astype(float).copy()
    least = d * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    columns: list[np.ndarray] = []
    done = np.zeros(d, bool)
    while len(columns) < d:
        p = int(np.argmax(np.where(done, -1.0, rest)))
        if done[p] or rest[p] <= least:
            break
        column = a[:, p].astype(float).copy()
        for other in columns:
            column -= other * other[p]
        column[done] = 0.0
        column /= np.sqrt(rest[p])
        column[p] = np.sqrt(rest[p])
        rest -= column * column
        done[p] = True
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((d, 0))


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of factor factor', largest first, and unit eigenvectors as columns, by rotating pairs of columns until all are orthogonal.

    A round rotates pairs that share no column, so it is done at once; the rounds of a sweep meet each pair once.
    """
    c = factor.copy()
    k = c.shape[1]
    if k > 1:
        ring = np.arange(k + k % 2)  # an odd number gets an idle place
        for _ in range(sweeps):
            turned = False
            for _ in range(len(ring) - 1):
                p, q = ring[: len(ring) // 2], ring[len(ring) // 2 :][::-1]
                real = (p < k) & (q < k)
                p, q = p[real], q[real]
                x, y = c[:, p], c[:, q]
                alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
                open_ = np.abs(gamma) > 1e-15 * np.sqrt(alpha * beta)
                if open_.any():
                    turned = True
                    zeta = np.where(open_, (beta - alpha) / np.where(open_, 2 * gamma, 1.0), 0.0)
                    t = np.where(open_, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
                    cos = 1 / np.sqrt(1 + t * t)
                    sin = cos * t
                    c[:, p], c[:, q] = cos * x - sin * y, sin * x + cos * y
                ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
            if not turned:
                break
    norms = np.sqrt((c * c).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, c[:, order] / norms[order]


@dataclass
class Whitening:
    """Of the fit list: how many vectors, their sums, components as columns, eigenvalues of the covariance, its trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs, or Python's integers where they would not fit."""
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, y: np.ndarray) -> np.ndarray:
        return (y / self.n).astype(float)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.components / np.sqrt(self.eigenvalues)


def scaled(v: Column) -> Column:
    """``v`` as longs, null where the vector takes no part."""
    whole = F.transform(v.cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))).cast("double"))
    fine = F.forall(v.cast("array<double>"), lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * F.lit(float(SCALE))) < F.lit(float(1 << 53))), F.lit(False)))
    return F.when(v.isNotNull() & (F.size(v) > 0) & fine, F.transform(whole, lambda c: c.cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    high = low = None
    n = 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            up = x // _PART
            high, low = (up.sum(0), (x - up * _PART).sum(0)) if high is None else (high + up.sum(0), low + (x - up * _PART).sum(0))
            n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(high)), pa.int32()), pa.array(high), pa.array(low), pa.array([n] * len(high), pa.int64())], ["i", "high", "low", "n"])


def _entries(fit: Whitening, of_rows):
    """Sums over a task's rows of the products of what ``of_rows`` makes of them (upper triangle), and of these themselves (i = -1)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = first = None
        for batch in batches:
            if batch.num_rows:
                w = of_rows(fit.centred(fit.deviations(_matrix(batch.column(0)))))
                total, first = (w.T @ w, w.sum(0)) if total is None else (total + w.T @ w, first + w.sum(0))
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(len(first), -1), i]), pa.int32()), pa.array(np.concatenate([np.arange(len(first)), j]), pa.int32()), pa.array(np.concatenate([first, total[i, j]]))], ["i", "j", "value"])

    return of


def _gathered(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    total, first = np.zeros((size, size)), np.zeros(size)
    for r in rows.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():  # at most (size + 1) ** 2 rows
        if r.i < 0:
            first[r.j] = r.value
        else:
            total[r.i, r.j] = total[r.j, r.i] = r.value
    return total, first


def fit(x: DataFrame, most: int = MOST) -> Whitening | None:
    """The whitening of the distinct vectors of column ``x`` (longs, one length); None where there is no vector."""
    spark = x.sparkSession
    ship(spark)
    distinct = materialize(x.select("x").distinct(), "fit-list")
    rows = distinct.mapInArrow(_sums, "i int, high long, low long, n long").groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")).orderBy("i").collect()
    if not rows:
        return None
    n, sums = rows[0].n, [r.high * _PART + r.low for r in rows]
    found = Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)
    scatter, _ = _gathered(distinct.mapInArrow(_entries(found, lambda d: d), "i int, j int, value double"), len(sums))
    values, vectors = jacobi(pivoted_cholesky(scatter))
    k = min(most, len(values))
    found = Whitening(n, sums, vectors[:, :k], values[:k] / n, float(np.trace(scatter)) / n)
    if k:
        total, first = _gathered(distinct.mapInArrow(_entries(found, found.project), "i int, j int, value double"), k)
        mean = first / n
        found.identity_error = float(np.abs(total / n - np.outer(mean, mean) - np.eye(k)).max())
    return found


def _whitened(fit: Whitening):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.eigenvalues)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                y = fit.deviations(_matrix(batch.column(1)))
                wide = y.astype(object) if y.shape[1] * float(np.abs(y).max(initial=0)) ** 2 >= 2.0**62 else y
                exact = (wide * wide).sum(1).tolist()
                w = fit.project(fit.centred(y))
                each = lambda values, kind: pa.array(np.repeat(np.array(values, object), k).tolist(), kind)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(w)), k))),
                    pa.array(np.tile(np.arange(1, k + 1), len(w)), pa.int32()),
                    pa.array(np.full(len(w) * k, fit.n)),
                    each([v if v < 1 << 63 else None for v in exact], pa.int64()),
                    pa.array(w.ravel()),
                    pa.array(np.tile(fit.eigenvalues / fit.trace, len(w))),
                    pa.array(np.full(len(w) * k, fit.identity_error)),
                    each([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return of


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", most: int = MOST) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact) for every row that takes part and component up to ``most``."""
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("x")).where(F.col("x").isNotNull())
    lengths = slim.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return slim.sparkSession.createDataFrame([], WHITENED)
    slim = slim.where(F.size("x") == lengths[0].dims)
    found = fit(slim, most)
    if found is None or not len(found.eigenvalues):
        return slim.sparkSession.createDataFrame([], WHITENED)
    return slim.mapInArrow(_whitened(found), WHITENED)
