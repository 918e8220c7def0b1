"""Vectors as rows of whole numbers, exact wherever they are multiplied."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
LARGEST = 1 << 24  # of a component, as a whole number: squares of 4,000 of them fit into 64 bits


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(math.inf)))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(vector: Column) -> Column:
    """floor(256 * x) of each component, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def matrices(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows of a list column as matrices, one for each vector length: (places, matrix)."""
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    out = []
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        at = offsets[places][:, None] + np.arange(length)[None, :]
        out.append((places, flat[at].reshape(len(places), int(length))))
    for _, matrix in out:
        if matrix.size and int(np.abs(matrix).max()) >= LARGEST:
            raise ValueError(f"a component of a vector is {LARGEST // SCALE} or more")
    return out


def exact_kind(bound: float) -> type:
    """The fastest number type that holds all whole numbers up to a bound exactly."""
    if bound < 2 ** 24:
        return np.float32
    if bound < 2 ** 53:
        return np.float64
    if bound < 2 ** 62:
        return np.int64
    raise ValueError("vectors too large for products of 64 bits")


def clean(rows: DataFrame, vector: str, **columns: Column) -> DataFrame:
    """`columns` and the whole numbers `q` of the rows whose vector is usable."""
    return rows.where(usable(F.col(vector))).select(
        *[c.alias(name) for name, c in columns.items()], whole(F.col(vector)).alias("q"))
