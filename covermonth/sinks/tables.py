"""Parquet reports and layer tables."""

from __future__ import annotations

import datetime
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.sinks.commits import (
    commit_version,
    current_commit,
    current_version,
    has_commits,
    is_object_store,
    new_version,
    sweep,
)
from covermonth.sinks.storage import discard, path_exists, publish, staging_path

log = logging.getLogger(__name__)

# Report names by base.
REPORT_NAMES = {
    S.BASE_CORE: "Consolidado_Emision_Core",
    S.BASE_CLAIMS: "Consolidado_Emision_Siniestros",
}
FILE_INDEX = "_file_index"
SORTED_REPORT_NAME = "Archivo_Consolidado_Ordenado.parquet"


def report_name(base: str, run_date: datetime.date | str) -> str:
    """Report name with the run date as yyyymmdd."""
    return f"{REPORT_NAMES[base]}_{str(run_date).replace('-', '')}.parquet"


def reprocessed_name(name: str) -> str:
    return f"{name.removesuffix('.parquet')}_Reproceso.parquet"


def _write_counted(
    df: DataFrame, path: str, fmt: str, options: dict, partition_by: str | None = None
) -> int:
    """Write and count in one pass over the data."""
    rows = Observation(f"rows-{uuid.uuid4().hex}")
    df = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    df.write.format(fmt).options(**options).partitionBy(partition_by or []).save(path)
    return rows.get["rows"]


def parquet_options(row_group_rows: int, zstd_level: int = 3) -> dict:
    return {
        "compression": "zstd",
        "parquet.compression.codec.zstd.level": str(zstd_level),
        "parquet.block.row.count.limit": str(row_group_rows),
    }


def write_report(
    df: DataFrame,
    path: str,
    drop_optional: bool = False,
    row_group_rows: int = S.ROW_GROUP_ROWS_REPORT,
    max_rows_per_file: int = S.FILE_ROWS_REPORT,
    by_log: bool | None = None,
    lookup_by: str | None = None,
) -> int:
    """Write a ZSTD Parquet report and return its number of rows.

    The report is put in place when complete; on failure, or if it
    would be empty, an older report stays as it was. ``by_log`` publishes it by
    a commit log instead of a rename; see ``published``. ``drop_optional`` leaves
    out PARENTESCO and FI. A task that has more than ``max_rows_per_file`` rows
    writes several files. ``lookup_by`` names a text column by which rows are to be
    found again: its row groups get Bloom filters, and the data an index of its files
    (see sources/lookup.py), which is published with it.
    """
    if drop_optional:
        df = df.drop(*S.CORE_OPTIONAL_COLUMNS)
    options = parquet_options(row_group_rows)
    options["maxRecordsPerFile"] = str(max_rows_per_file)
    if lookup_by is not None:
        options[f"parquet.bloom.filter.enabled#{lookup_by}"] = "true"
    return _write_and_publish(
        df, path, "parquet", options, _check_row_count, by_log=by_log, lookup_by=lookup_by)


def _write_file_index(spark: SparkSession, folder: str, column: str) -> None:
    """Smallest and largest value of ``column`` in each file, in a folder within the data.

    Readers of the data do not see the folder, and it moves with the data. One column is
    read for it, and a row per file is written.
    """
    files = spark.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(column).alias("first"), F.max(column).alias("last"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(column).isNull()).alias("without"))
    files.coalesce(1).write.parquet(f"{folder}/{FILE_INDEX}")


def _check_row_count(written: DataFrame, rows: int) -> None:
    """Compare with the row counts in the written files' footers."""
    found = written.count()
    if found != rows:
        raise ValueError(f"{found} rows written instead of {rows}")


def _write_and_publish(
    df: DataFrame, path: str, fmt: str, options: dict, check=None, partition_by: str | None = None,
    by_log: bool | None = None, lookup_by: str | None = None,
) -> int:
    spark = df.sparkSession
    if by_log is None:
        by_log = is_object_store(path) or has_commits(spark, path)
    if by_log:
        return _write_and_commit(
            df, path, fmt, options, check, partition_by, lookup_by=lookup_by)
    staged = staging_path(path)
    log.info("%s: %s", path, df.schema.simpleString())
    try:
        rows = _write_counted(df, staged, fmt, options, partition_by)
        if rows == 0:
            raise ValueError(f"no rows for {path}")
        if check is not None:
            check(spark.read.format(fmt).load(staged), rows)
        if lookup_by is not None:
            _write_file_index(spark, staged, lookup_by)
        publish(spark, staged, path)
    except Exception:
        discard(spark, staged)
        raise
    log.info("%s: %d rows", path, rows)
    return rows


def _write_and_commit(
    df: DataFrame, path: str, fmt: str, options: dict, check=None, partition_by: str | None = None,
    only_after: int | None = None, lookup_by: str | None = None,
) -> int:
    """Write a new version and publish it by one entry of the log.

    What fails or is stopped before that entry leaves the old version for all
    readers. ``only_after`` is the number of the commit that the new one must follow.
    """
    spark = df.sparkSession
    version = new_version(path)
    log.info("%s: %s", path, df.schema.simpleString())
    rows = _write_counted(df, version, fmt, options, partition_by)
    if rows == 0:
        raise ValueError(f"no rows for {path}")
    if check is not None:
        check(spark.read.format(fmt).load(version), rows)
    if lookup_by is not None:
        _write_file_index(spark, version, lookup_by)
    commit = commit_version(spark, path, version, rows, only_after)
    log.info("%s: %d rows, commit %d", path, rows, commit.number)
    sweep(spark, path)
    return rows


def replace_if_unchanged(df: DataFrame, path: str, commit: int, fmt: str = "parquet") -> int:
    """Replace a table published by a log, if ``commit`` is still its last one (0: none).

    For a table that is made from its own last version: if another writer
    came first, CommitConflict is raised and nothing is lost.
    """
    return _write_and_commit(df, path, fmt, {}, only_after=commit)


def published(spark: SparkSession, path: str) -> str:
    """Where the data of a report or table lies.

    Tables are published by rename or, on object stores or once they have one, by a commit
    log. In the second case the data of the last complete commit is meant.
    """
    return current_version(spark, path) if has_commits(spark, path) else path


def last_commit(spark: SparkSession, path: str) -> int:
    """Number of the last complete commit of a table, 0 if there is none."""
    commit = current_commit(spark, path)
    return commit.number if commit else 0


def layer_path(lake: str, layer: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{layer}/{table}"


def save_layer(
    df: DataFrame, lake: str, layer: str, table: str, fmt: str = "parquet", check=None,
    partition_by: str | None = None, by_log: bool | None = None,
) -> int:
    """Replace a layer table, schema included, and return its row count.

    ``check`` may look at the written table before it is put in place. Other
    formats than Parquet must be set up in the session.
    """
    return _write_and_publish(
        df, layer_path(lake, layer, table), fmt, {}, check, partition_by, by_log)


def layer_exists(spark: SparkSession, lake: str, layer: str, table: str) -> bool:
    path = layer_path(lake, layer, table)
    if has_commits(spark, path):
        return current_commit(spark, path) is not None
    return path_exists(spark, path)


def load_layer(
    spark: SparkSession, lake: str, layer: str, table: str, fmt: str = "parquet"
) -> DataFrame:
    return spark.read.format(fmt).load(published(spark, layer_path(lake, layer, table)))
