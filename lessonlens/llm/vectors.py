"""Integer vectors: what the three operators on ``embeddings`` share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2.0 ** 26  # scaled components must stay below: their products' sums then fit a long


def integers(rows: DataFrame, scale: int, offset: int = 0, length: int | None = None,
             limit: float = LIMIT, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id`` (long) and ``vec`` (array of ``floor(scale * component) + offset``, components as
    doubles) of the rows whose vector is not null or empty and holds no null, non-finite or
    oversized (``scale * component`` of ``limit`` or more) component.  Other columns are not read."""
    kind = "int" if limit <= LIMIT else "long"
    fits = F.forall(column, lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < limit))
    good = rows.where(F.col(column).isNotNull() & fits & (F.size(column) > 0))
    if length is not None:
        good = good.where(F.size(column) == length)
    scaled = F.transform(column, lambda c: (F.floor(c.cast("double") * scale) + offset).cast(kind))
    return good.select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("vec"))


def lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A matrix as an Arrow array of lists, one per row."""
    n, d = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), pa.array(values.reshape(-1), kind))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as an int64 matrix."""
    if len(column) == 0:
        return np.zeros((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def by_length(column: pa.Array):
    """(indices, int64 matrix) for each length among the lists."""
    sizes = np.diff(column.offsets.to_numpy())
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, matrix(column if len(at) == len(column) else column.take(pa.array(at)))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of int64 matrices, by the fastest type that holds every partial sum."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def squares(a: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, a)
