"""Rows of a few documents from a large report, without reading the rest of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth.sinks.storage import path_exists
from covermonth.sinks.tables import FILE_INDEX, published

# Values are compared with each file's bounds and pushed to the scan; longer lists are for a join.
MAX_VALUES = 1000


def find_documents(
    spark: SparkSession, path: str, documents: list[str | None], column: str = "NRO_DOCUMENTO",
) -> DataFrame:
    """All rows of a report whose ``column`` is one of ``documents``; None finds NULLs.

    A report written with ``lookup_by`` has an index of its files: only files whose bounds hold
    one of the values are opened, and within them row groups are skipped by their statistics
    and Bloom filters. In a sorted report that is one file per value, or the files of a document that
    fills several. A report without an index is read with the pushed filter alone; the rows
    are the same. More than MAX_VALUES values are an error: use a join.
    """
    if len(documents) > MAX_VALUES:
        raise ValueError(f"{len(documents)} documents to look up, join for more than {MAX_VALUES}")
    folder = published(spark, path)
    report = spark.read.parquet(folder)
    files = files_with(spark, folder, documents)
    if files is not None:
        # No file at all: an empty frame of the same columns.
        report = (spark.read.schema(report.schema).parquet(*files) if files
                  else spark.createDataFrame([], report.schema))
    return report.where(_is_one_of(F.col(column), documents))


def files_with(
    spark: SparkSession, folder: str, documents: list[str | None],
) -> list[str] | None:
    """The data files that can hold one of the values; None if the report has no index.

    Only names of files that can match come to the driver, as for any scan of them.
    """
    index = f"{folder.rstrip('/')}/{FILE_INDEX}"
    if not path_exists(spark, index):
        return None
    values = F.array(*[F.lit(d) for d in documents if d is not None]).cast("array<string>")
    inside = F.exists(values, lambda v: v.between(F.col("first"), F.col("last")))
    can_match = F.coalesce(inside, F.lit(False))
    if None in documents:
        can_match = can_match | (F.col("without") > 0)
    found = spark.read.parquet(index).where(can_match).select("file")
    return sorted(f"{folder.rstrip('/')}/{row.file}" for row in found.toLocalIterator())


def _is_one_of(column: Column, documents: list[str | None]) -> Column:
    found = column.isin([d for d in documents if d is not None])
    return found | column.isNull() if None in documents else found
