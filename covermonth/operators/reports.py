"""Operators on consolidated reports: union, last digit and global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.text import last_digit


def union_bases(core: DataFrame, claims: DataFrame) -> DataFrame:
    """All consolidated rows; columns that one side lacks become NULL."""
    return core.unionByName(claims, allowMissingColumns=True)


def add_last_digit(df: DataFrame) -> DataFrame:
    """Add ULT_DIGI_DOC, by which the dashboard splits its load."""
    df = df.withColumn("ULT_DIGI_DOC", last_digit(F.col("NRO_DOCUMENTO")))
    return df.select(*S.REPROCESSED_COLUMNS)


def order_by_document(
    df: DataFrame, partitions: int | None = None, tie_breaker: Column | None = None
) -> DataFrame:
    """Rows in the order of document and month, NULLs last, over all files.

    Rows are spread over sorted ranges, so that files and row groups can be
    skipped by document. One document, or one month of it, may hold a large
    part of all rows: ``tie_breaker`` comes last in the range key and cuts
    such runs into several ranges without changing the order. It defaults to
    a hash of the row, which does not separate rows that are copies of each
    other; a row number of the input does. Without ``partitions``, adaptive
    execution merges small neighbouring ranges.
    """
    keys = [F.col("NRO_DOCUMENTO").asc_nulls_last(), F.col("F_OCURRENCIA").asc_nulls_last()]
    spread = F.xxhash64(*df.columns) if tie_breaker is None else tie_breaker
    ranges = [*keys, spread.asc()]
    if partitions is None:
        df = df.repartitionByRange(*ranges)
    else:
        df = df.repartitionByRange(partitions, *ranges)
    return df.sortWithinPartitions(*keys)
