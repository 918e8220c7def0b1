"""Consolidated Parquet reports as input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.sinks.storage import list_names, require_path
from covermonth.sinks.tables import published


def report_paths(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the Parquet reports in ``folder``; none is an error."""
    require_path(spark, folder, "report folder")
    names = list_names(spark, folder, ".parquet")
    if not names:
        raise FileNotFoundError(f"no Parquet reports in {folder}")
    return [f"{folder.rstrip('/')}/{name}" for name in names]


def open_report(spark: SparkSession, path: str) -> DataFrame:
    """A report, whichever way it was published."""
    return spark.read.parquet(published(spark, path))


def read_reports(spark: SparkSession, folder: str, row_number: str | None = None) -> DataFrame:
    """All reports together; columns that some of them lack become NULL.

    Reports are few and each has one schema, so they are united by name
    instead of merging the schemas of all their files. ``row_number`` names a
    column to add with the number of each row within its file.
    """
    parts = [open_report(spark, path) for path in report_paths(spark, folder)]
    if row_number is not None:
        parts = [p.withColumn(row_number, F.col("_metadata.row_index")) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def check_report(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The report, if it has as many columns as given and any row."""
    df = open_report(spark, path)
    if len(df.columns) != len(columns):
        raise ValueError(
            f"wrong number of columns in {path}: {len(df.columns)}, expected {len(columns)}")
    df = df.select(*columns)
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def read_consolidated(spark: SparkSession, folder: str) -> DataFrame:
    """All consolidated reports, each checked for width and rows first."""
    paths = report_paths(spark, folder)
    for path in paths:
        check_report(spark, path, S.CONSOLIDATED_COLUMNS)
    found = [published(spark, path) for path in paths]
    return spark.read.parquet(*found).select(*S.CONSOLIDATED_COLUMNS)
