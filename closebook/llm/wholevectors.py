"""Vectors of whole numbers: floors of scaled components, exact sums of squares and products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest and smallest value of a long; what lies beyond is taken as it.
MOST, LEAST = 2**63 - 1, -(2**63)


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def floored(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component x as a double; floors beyond a long are its ends."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as rows of longs."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64, copy=False)


def ragged(column: pa.Array) -> np.ndarray:
    """Arrays of any lengths as rows of longs, the shorter ones filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows[row, place] = column.flatten().to_numpy(zero_copy_only=False)
    return rows


def largest(*arrays: np.ndarray) -> int:
    """The largest size of any component."""
    return max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)


def exact(terms: int, most: int, *arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays in a type in which ``terms`` products of numbers up to ``most`` add up exactly.

    That is a long where their sum fits; else Python's unbounded integers.
    """
    return arrays if terms * most * most < MOST else tuple(a.astype(object) for a in arrays)


def saturated(values: np.ndarray) -> np.ndarray:
    """Whole numbers as longs; what lies beyond is the end of the range."""
    if values.dtype == object:
        values = np.array([min(max(int(v), LEAST), MOST) for v in values], dtype=np.int64)
    return values.astype(np.int64, copy=False)


def long_sum(column: str) -> Column:
    """Exact sum of longs; beyond a long, its end."""
    total = F.sum(F.col(column).cast("decimal(38,0)"))
    return F.greatest(F.least(total, F.lit(MOST)), F.lit(LEAST)).cast("long")
