"""Whitening of embeddings, with exact covariances by polarisation.

Vectors become integers. Squares of centred values are summed exactly for every dimension and for every sum of two
dimensions; as var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of those variances are the covariances. They are
assembled into the matrix whose eigenvectors whiten the vectors.

Centred means less the mean rounded to an integer, so that the squares stay exact; what rounding left is taken off the
sums, in integers of any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.session import materialize

STEPS, OFFSET = 64, 1_000_000
#: Steps beyond this, either way, count as this many.
MOST_STEPS = 1 << 50
#: Components returned.
COMPONENTS = 16
#: Eigenvalues up to this share of the trace are rounding: their components whiten nothing.
LEAST_SHARE = 1e-13


@dataclass(frozen=True)
class Whitening:
    """The fit: ``n`` distinct vectors with ``sums`` per dimension, components as columns, and their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def middle(self) -> np.ndarray:
        """The means, rounded."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def usable(self) -> np.ndarray:
        return self.values > LEAST_SHARE * self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: 64-bit integers where they suffice, else Python's."""
        y = x - self.middle
        rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)], dtype=object)
        if (int(np.abs(y).max(initial=0)) + 1) * self.n < 1 << 62:
            return y * self.n - rest.astype(np.int64)
        return y.astype(object) * self.n - rest

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Projections on the components over the roots of their eigenvalues; NaN where the eigenvalue is 0."""
        scale = np.where(self.usable, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (centred.astype(np.float64) / self.n) @ self.vectors / scale


def finite_vectors(rows: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``x``, the vector in whole steps, of the rows whose vector is whole, finite and not empty."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    steps = lambda c: F.greatest(F.lit(-MOST_STEPS), F.least(F.lit(MOST_STEPS), F.floor(c * STEPS))) + OFFSET
    return rows.filter(entries.isNotNull() & (F.size(entries) > 0) & whole).select(*[F.col(f"`{c}`") for c in keep], F.transform(entries, steps).alias("x"))


def _of_usual_length(found: DataFrame) -> tuple[DataFrame, int]:
    usual = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = usual["d"] if usual else 0
    return found.filter(F.size("x") == d), d


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("x"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


_SUMS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.string())])


def _summed(fit: DataFrame, per_batch, shape: tuple[int, ...], d: int) -> dict[tuple[int, int], int]:
    """Sums over all rows of what ``per_batch`` makes of a matrix: one row an entry and task, added up by Spark."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                total = total + per_batch(_matrix(batch.slice(at, 1024), d)).astype(object)
        at = np.argwhere(total != 0)
        if len(at):
            at = at if at.shape[1] == 2 else np.column_stack([at, at])
            flat = total.ravel() if total.ndim == 1 else total
            values = [str(flat[i] if total.ndim == 1 else flat[i, j]) for i, j in at]
            yield pa.RecordBatch.from_arrays([pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(values)], schema=_SUMS)

    found = fit.select("x").mapInArrow(sums, "i int, j int, total string")
    added = found.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {(r["i"], r["j"]): int(r["total"]) for r in added.collect()}  # as many as the matrix has entries


def square_sums(y: np.ndarray) -> np.ndarray:
    """Above the diagonal the sums of (y_i + y_j)^2, on it those of y_i^2, exactly."""
    d = y.shape[1]
    # at most 1024 rows: 4 * 2^52 * 2^10 fit in 64 bits
    exact = y if int(np.abs(y).max(initial=0)) < 1 << 25 else y.astype(object)
    out = np.zeros((d, d), dtype=exact.dtype)
    for i in range(d):
        out[i, i] = (exact[:, i] * exact[:, i]).sum()
        pairs = exact[:, i + 1 :] + exact[:, i : i + 1]
        out[i, i + 1 :] = (pairs * pairs).sum(axis=0)
    return out


def fit_whitening(fit: DataFrame, d: int, most: int = COMPONENTS) -> Whitening | None:
    """The fit over ``fit`` (x, each vector once, of ``d`` dimensions); None without rows.

    The driver gets a row for each dimension and pair of dimensions, whatever the number of vectors.
    """
    n = fit.count()
    if not n:
        return None
    by_dimension = _summed(fit, lambda x: x.sum(axis=0), (d,), d)
    sums = tuple(by_dimension.get((i, i), 0) for i in range(d))
    middle = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0).middle
    squares = _summed(fit, lambda x: square_sums(x - middle), (d, d), d)
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    # n^2 times the variance of a dimension, and of the sum of two
    single = [n * squares.get((i, i), 0) - rest[i] ** 2 for i in range(d)]
    covariance = np.zeros((d, d))
    for i in range(d):
        covariance[i, i] = single[i] / (n * n)
        for j in range(i + 1, d):
            both = n * squares.get((i, j), 0) - (rest[i] + rest[j]) ** 2
            covariance[i, j] = covariance[j, i] = (both - single[i] - single[j]) / (2 * n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = np.maximum(values[::-1][:most], 0.0), vectors[:, ::-1][:, :most]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, vectors, values, sum(single) / (n * n))


def identity_error(fit: DataFrame, found: Whitening, d: int) -> float | None:
    """Largest absolute entry of the whitened fit's covariance less the identity, over the components that whiten; None without one."""
    use = np.flatnonzero(found.usable)
    if not len(use):
        return None

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(use), len(use)))
        for batch in batches:
            z = found.whitened(found.centred(_matrix(batch, d)))[:, use]
            total += z.T @ z  # the whitened fit is centred
        at = np.argwhere(total == total)
        yield pa.RecordBatch.from_arrays([pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    added = fit.select("x").mapInArrow(sums, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return max(abs(r["s"] / found.n - (r["i"] == r["j"])) for r in added.collect())


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: ``key``, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.

    Rows leave whose vector is null or empty, or holds null or non-finite entries, and those of another length than
    most have (of equally frequent lengths the longer stays). Fitted are the distinct vectors, each once; all remaining
    rows come back, repeated ones and a null ``key`` included. ``deviation`` is null where it doesn't fit in 64 bits;
    ``whitened`` is null for a component without variance, and identity_error where no component has any. An empty table
    gives no row; other columns aren't read. The fit list is written to the shared folder.
    """
    found, d = _of_usual_length(finite_vectors(rows, vector, [key]))
    fit = materialize(found.select("x").distinct(), "vectors")
    fitted = fit_whitening(fit, d, most) if d else None
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, fitted, d)
    k = fitted.vectors.shape[1]
    share = fitted.values / fitted.trace if fitted.trace else np.zeros(k)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                centred = fitted.centred(_matrix(batch, d))
                m = len(centred)
                fits = int(np.abs(centred).max(initial=0)) ** 2 * d < 1 << 63
                if not fits:
                    centred = centred.astype(object)
                deviation = (centred * centred).sum(axis=1)
                deviations = pa.array(deviation if fits else [int(v) if v < 1 << 63 else None for v in deviation], pa.int64())
                z = fitted.whitened(centred).ravel()
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(batch.schema.get_field_index(key)).take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, fitted.n), pa.int64()), deviations.take(each), pa.array(z, mask=np.isnan(z)),
                    pa.array(np.tile(share, m)), pa.array([error] * (m * k), pa.float64()),
                ], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return found.mapInArrow(projected, schema)
