"""A bitmap of fixed size that tells, without a join, which rows can match.

It lets through every value that was put in and few others, so that what needs a shuffle is
small. It is the one thing broadcast, and its size is a parameter: with more values it
lets more rows through, and the join that follows still decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24  # 2 MB
_SHIFTS = (0, 20, 40)


def bitmap(values: DataFrame, column: str, probes: int = 1, bits: int = BITS) -> np.ndarray:
    """Bits of a long column; at most bits / 64 words reach the driver.

    With several probes a value sets as many bits, taken from different parts of it: for hashes,
    few others then have all of them.
    """
    places = F.explode(F.array(*[
        F.shiftrightunsigned(column, _SHIFTS[k]).bitwiseAND(F.lit(bits - 1).cast("long"))
        for k in range(probes)])).alias("place")
    found = (values.where(F.col(column).isNotNull()).select(places)
             .groupBy(F.shiftright("place", 6).cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("mask")))
    out = np.zeros(bits // 64, np.uint64)
    table = found.toArrow()
    out[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
    return out


def possible(bits: np.ndarray, values: np.ndarray, probes: int = 1) -> np.ndarray:
    """Which of the 64-bit values may be in the bitmap."""
    values = values.view(np.uint64)
    last = np.uint64(len(bits) * 64 - 1)
    left = np.arange(len(values))
    for k in range(probes):
        place = (values[left] >> np.uint64(_SHIFTS[k])) & last
        left = left[(bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0]
    out = np.zeros(len(values), bool)
    out[left] = True
    return out
