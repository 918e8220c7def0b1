"""Plan boundary between rules that rewrite columns and filters on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_barrier(df: DataFrame) -> DataFrame:
    """Same rows, but later filters are evaluated above this point.

    The optimizer moves a filter below the projections that define its
    columns by copying their expressions into it. With several layers of CASE
    expressions the copies multiply: planning takes seconds and every row is
    evaluated many times over. Filters are not moved below a generator that
    produces their columns, so one row goes in and comes out of ``inline``.
    It is part of whole-stage code generation and needs no shuffle.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
