"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

The scatter of the distinct vectors is summed over the cluster, centred first: every task turns
its rows into differences from the mean (an integer part, subtracted exactly, and a remainder
below one) and multiplies only those.  The driver then holds one matrix of dimension x dimension:
a Cholesky factorisation with diagonal pivots writes it as ``L L^T``, and plane rotations of
L's columns make them orthogonal.  Their squared norms are the eigenvalues, the normalised
columns the components, each to high relative accuracy.

Defined cases
    null or non-finite    a vector that is null or empty, or holds a null, NaN or infinite entry, or one
                          of 2**34 or more, is dropped
    other lengths         a table has vectors of one length; where lengths differ, those of the commonest
                          length stay (of equally common ones the longest)
    repeated rows         each gives its rows; the fit counts a vector once
    null vec_id           keeps its rows, with a null id
    too few directions    a component with eigenvalue zero (fewer distinct vectors or dimensions than
                          components) has no whitened value and no rows; so a single distinct
                          vector gives none
    deviation             null if it does not fit a long (n * |x - mean| beyond about 10**9)
    empty table           no rows
    ties                  equal eigenvalues: any basis of their space, the same for all rows
    further columns       not read, so their names cannot clash
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import stored
from lessonlens.llm.vectors import integers, matrix

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LIMIT = 2.0 ** 40


class Fit(NamedTuple):
    n: int                   # distinct vectors
    whole: np.ndarray        # floor of the mean, by dimension (int64)
    rest: np.ndarray         # n * mean - n * whole, in [0, n)
    trace: float             # of the covariance
    values: np.ndarray       # eigenvalues, falling
    axes: np.ndarray         # unit eigenvectors, one a column


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Columns of L (dimension x rank, rows in the order of ``a``) with ``L @ L.T == a``; in the
    order of the pivots it is lower triangular.  Stops where only rounding is left."""
    left = np.array(a, dtype=np.float64)
    d = len(left)
    floor = d * np.finfo(np.float64).eps * max(left.diagonal().max(initial=0.0), 0.0)
    columns = []
    for _ in range(d):
        p = int(np.argmax(left.diagonal()))
        if left[p, p] <= floor:
            break
        c = left[:, p] / np.sqrt(left[p, p])
        left -= np.outer(c, c)
        left[p, :] = left[:, p] = 0.0       # exact: the pivot's row is used up
        columns.append(c)
    return np.array(columns).T.reshape(d, -1)


def jacobi(l: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of ``l @ l.T`` by one-sided rotations.

    A sweep meets every pair of columns once, in rounds of disjoint pairs that turn together."""
    u = np.array(l, dtype=np.float64)
    r, tolerance = u.shape[1], len(u) * np.finfo(np.float64).eps
    seats = np.arange(r + r % 2)            # an odd number gets an empty seat
    for _ in range(sweeps if r > 1 else 0):
        turned = False
        for _ in range(len(seats) - 1):
            i, j = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
            both = (i < r) & (j < r)
            i, j = i[both], j[both]
            x, y = u[:, i], u[:, j]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(c) > tolerance * np.sqrt(a * b)
            if off.any():
                turned = True
                i, j, x, y = i[off], j[off], x[:, off], y[:, off]
                zeta = (b[off] - a[off]) / (2 * c[off])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, t)
                sin = cos * t
                u[:, i], u[:, j] = cos * x - sin * y, sin * x + cos * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    norms = np.sqrt((u * u).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, u[:, order] / norms[order]


def centred(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """``x - mean`` as doubles: the integer part of the mean is subtracted exactly."""
    return (x - whole).astype(np.float64) - rest / n


def totals(rows: DataFrame, measure, size: int, kind: str) -> np.ndarray:
    """Sum over all rows of the flat array that ``measure`` gives for a matrix of vectors: each
    task adds up its own, then the tasks' arrays are added by position."""
    out = pa.schema([("at", pa.int32()), ("value", pa.int64() if kind == "decimal(38,0)" else pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = measure(matrix(b.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total, out[1].type)], schema=out)

    parts = rows.select("vec").mapInArrow(run, f"at int, value {'long' if kind == 'decimal(38,0)' else 'double'}")
    summed = parts.groupBy("at").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()
    got = {r.at: r.value for r in summed}
    return np.array([int(got[k]) if kind == "decimal(38,0)" else got[k] for k in range(size)],
                    dtype=object if kind == "decimal(38,0)" else np.float64)


def fit(distinct: DataFrame, n: int, dimension: int) -> Fit:
    """Mean, spectrum and axes of the ``n`` rows of ``distinct`` (column ``vec``)."""
    sums = totals(distinct, lambda x: x.sum(0), dimension, "decimal(38,0)")
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    upper = np.triu_indices(dimension)

    def scatter(x: np.ndarray) -> np.ndarray:
        z = centred(x, n, whole, rest)
        return (z.T @ z)[upper]

    covariance = np.zeros((dimension, dimension))
    covariance[upper] = totals(distinct, scatter, len(upper[0]), "double") / n
    covariance = covariance + np.triu(covariance, 1).T
    values, axes = jacobi(pivoted_cholesky(covariance))
    return Fit(n, whole, rest, float(np.trace(covariance)), values, axes)


def deviations(x: np.ndarray, f: Fit) -> list[int | None]:
    """Exact ``sum((n * x - S) ** 2)`` of each row; None beyond a long."""
    y = x - f.whole
    most = f.n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return ((f.n * y - f.rest) ** 2).sum(1).tolist()
    wide = f.n * y.astype(object) - f.rest.astype(object)
    return [v if v < 1 << 63 else None for v in (wide * wide).sum(1).tolist()]


def whitened(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET, components: int = COMPONENTS) -> DataFrame:
    """One row per vector of ``rows`` (``vec_id``, ``embedding``) and component: ``vec_id``,
    ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    spark = rows.sparkSession
    vectors = integers(rows, scale, offset, limit=LIMIT)
    lengths = vectors.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dimension = lengths["d"]
    vectors = vectors.where(F.size("vec") == dimension)
    distinct = stored(vectors.select("vec").distinct())
    f = fit(distinct, distinct.count(), dimension)
    k = min(components, len(f.values))
    if not k:
        return spark.createDataFrame([], schema)
    axes = f.axes[:, :k] / np.sqrt(f.values[:k])

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x, f.n, f.whole, f.rest) @ axes
        return (w.T @ w).reshape(-1)

    error = float(np.abs(totals(distinct, spread, k * k, "double").reshape(k, k) / f.n - np.eye(k)).max())
    explained = f.values[:k] / f.trace
    out = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(1))
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, f.n), pa.int64()), pa.array(deviations(x, f), pa.int64()).take(each),
                pa.array((centred(x, f.n, f.whole, f.rest) @ axes).reshape(-1)),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema=out)

    return vectors.mapInArrow(project, schema)
