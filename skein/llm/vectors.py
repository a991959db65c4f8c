"""Integer vectors: components of embeddings times 256, rounded down, held in the narrowest exact form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Below this, sums of products in double precision are exact.
EXACT = 1 << 53
LONG = (1 << 63) - 1


def floats(df: DataFrame, vector: str) -> Column:
    """The vector as an array of float or of double."""
    v = F.col(vector)
    return v if "float" in dict(df.dtypes)[vector] else v.cast("array<double>")


def finite(v: Column) -> Column:
    """No null, no null and no non-finite component."""
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The components of all vectors of an Arrow list column, end to end, in double precision, and the boundaries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    off = column.offsets.to_numpy().astype(np.int64)
    return flat, off - off[0] if len(off) else np.zeros(1, np.int64)


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(256 * x): integers in double precision, or Python's own where 256 * x passes double precision."""
    with np.errstate(over="ignore"):
        out = np.floor(x * 256)
    if np.isfinite(out).all():
        return out
    # So large a number is an integer itself.
    exact = [int(v) * 256 if abs(v) >= EXACT else int(np.floor(v * 256)) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def greatest(m: np.ndarray) -> int:
    """The largest magnitude of a matrix of integers, as Python's integer."""
    if not m.size:
        return 0
    return max(abs(int(m.max())), abs(int(m.min())))


def integers(m: np.ndarray) -> np.ndarray:
    """A matrix of integers as int64, or as Python's integers where those do not fit."""
    if m.dtype == object:
        return m
    return m.astype(np.int64) if greatest(m) < LONG else np.array([int(v) for v in m.ravel().tolist()], object).reshape(m.shape)


def clipped(values) -> np.ndarray:
    """Integers as int64; those beyond it become the nearest that it holds."""
    a = np.asarray(values)
    return a if a.dtype == np.int64 else np.array([min(max(int(v), -LONG - 1), LONG) for v in a.tolist()], np.int64)
