"""Embeddings as vectors of whole numbers: floor(scale * component), with unusable rows left out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def usable(vector: Column) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component) of each component, taken as double; numbers beyond a long become the nearest long."""
    edge = float(1 << 63)

    def one(c: Column) -> Column:
        x = F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-edge)), F.lit(edge * (1 - 2.0**-53))))
        return x.cast("long")

    return F.transform(vector, one)


def padded(vector: Column, width: int) -> Column:
    """The vector with zeros up to width."""
    return F.concat(vector, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(vector)))


def widest(rows: DataFrame, vector: str) -> int:
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of exactly width longs as a matrix."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [np.asarray(c.flatten()).reshape(len(c), width) for c in chunks]
    return np.concatenate(parts) if parts else np.zeros((0, width), np.int64)


def largest(x: np.ndarray) -> int:
    """The largest absolute value, as a Python number: -2**63 has no positive long."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T without rounding: as doubles where these hold it, else as longs, else as Python numbers."""
    most = largest(a) * largest(b) * max(a.shape[1], 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return a.astype(object) @ b.astype(object).T
