"""The jobs: layered run, direct run, reprocessing and sorting."""

from __future__ import annotations

import datetime
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.dates import DEFAULT_YEAR_PIVOT
from covermonth.operators.claims import consolidate_claims
from covermonth.operators.core import consolidate_core, consolidate_core_strict
from covermonth.operators.reports import add_last_digit, order_by_document
from covermonth.sinks.storage import discard, require_path, staging_path
from covermonth.sinks.tables import (
    SORTED_REPORT_NAME,
    layer_exists,
    layer_path,
    load_layer,
    report_name,
    reprocessed_name,
    save_layer,
    write_report,
)
from covermonth.sources.csv_files import CsvLayout, read_core
from covermonth.sources.parquet_files import read_consolidated, read_reports, report_paths
from covermonth.sources.workbooks import claims_rows, read_workbooks, require_claims

log = logging.getLogger(__name__)

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
CORE, CLAIMS = "core", "claims"
ALL_LAYERS = (BRONZE, SILVER, GOLD)
ALL_SOURCES = (CORE, CLAIMS)

# Partition column of the bronze claims: rows that stand for a skipped sheet.
_SKIPPED = "SKIPPED"
# Rows of a sort task before compression, and the size of one in memory. A task of an executor
# with 1.5 GB of heap for each core sorts 0.8 GB without spilling.
_RANGE_BYTES = 512 * 1024 * 1024
_RAW_ROW_BYTES = 300
# Policies that break strict dates: their layer, the partition column, where they come from.
REJECTS = "rejects"
_REJECTED = "REJECTED"
_ORIGIN = ("FILE", "BRONZE_FILE", "BRONZE_ROW")
# Number of a row within its Parquet file, while rows are put in order.
_ROW = "_row"
_BASES = {CORE: S.BASE_CORE, CLAIMS: S.BASE_CLAIMS}


@dataclass(frozen=True)
class Options:
    """How sources are read and rows consolidated; see read_core and consolidate_core.

    ``fmt`` is the format of the layer tables, any that the session knows.
    ``by_log`` publishes tables and reports by a commit log (None: on object stores).
    ``keep_rejects`` is for strict dates in layers: see build_silver.
    """

    always_clean: bool = False
    quoted_newlines: bool = False
    fail_fast: bool = False
    date_mode: str = "lenient"
    year_pivot: int = DEFAULT_YEAR_PIVOT
    blank_ruc_is_null: bool = False
    keep_rejects: bool = False
    drop_optional: bool = False
    fmt: str = "parquet"
    by_log: bool | None = None

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        return read_core(spark, root, always_clean=self.always_clean, fail_fast=self.fail_fast,
                         quoted_newlines=self.quoted_newlines)

    def consolidate(self, raw: DataFrame, source: str, run_date) -> DataFrame:
        if source == CLAIMS:
            return consolidate_claims(raw, run_date, self.year_pivot)
        return consolidate_core(
            raw, run_date, self.date_mode, self.year_pivot, self.blank_ruc_is_null)


@dataclass(frozen=True)
class Paths:
    """Where a run reads and writes; any file system Spark can use."""

    core: str | None = None
    claims: str | None = None
    lake: str | None = None
    reports: str | None = None


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("FECHA_CARGA", F.current_timestamp())


# --- bronze --------------------------------------------------------------

def ingest_core(
    spark: SparkSession, root: str, lake: str, options: Options = Options(),
    layout: CsvLayout | None = None,
) -> int:
    """Raw policy rows with their file name and load time; returns the count."""
    require_path(spark, root, "policy folder")
    df = read_core(spark, root, layout) if layout else options.read(spark, root)
    return save_layer(with_load_time(df.drop("FOLDER")), lake, BRONZE, CORE, options.fmt,
                      by_log=options.by_log)


def ingest_claims(
    spark: SparkSession, root: str, lake: str, options: Options = Options()
) -> int:
    """Raw claims rows with their file name and load time; returns the count.

    The workbooks are parsed and written once. Skipped sheets lie in a partition of
    the same table, so that they can be looked up; readers of claims leave it out.
    """
    require_path(spark, root, "claims folder")
    parsed = with_load_time(read_workbooks(spark, root)).withColumn(
        _SKIPPED, F.col("ERROR").isNotNull())
    save_layer(parsed, lake, BRONZE, CLAIMS, options.fmt, partition_by=_SKIPPED,
               by_log=options.by_log, check=lambda written, _: require_claims(written))
    return load_claims(spark, lake, options.fmt).count()


def load_claims(spark: SparkSession, lake: str, fmt: str = "parquet") -> DataFrame:
    """Claims of the bronze table, without skipped sheets."""
    parsed = load_layer(spark, lake, BRONZE, CLAIMS, fmt).where(~F.col(_SKIPPED))
    return parsed.select(*S.CLAIMS_COLUMNS, "FILE", "FECHA_CARGA")


# --- silver and gold -----------------------------------------------------

class RejectedRows(ValueError):
    """Policies break strict dates; ``counts`` has them by column, and all as ``policies``."""

    def __init__(self, counts: dict[str, int], where: str):
        super().__init__(f"dates that are not d/m/Y, see {where}: {counts}")
        self.counts = counts


def build_silver(
    spark: SparkSession, lake: str, source: str,
    run_date: datetime.date | str | None = None, options: Options = Options(),
) -> int:
    """Consolidated rows from the bronze table of ``source``.

    With ``keep_rejects``, the policies that break strict dates are written to the table
    ``rejects/core`` with their texts, one fault bit per column and their place in the bronze
    table, and RejectedRows tells how many there are. The silver table stays as it was.
    """
    if options.keep_rejects and source == CORE:
        return _silver_or_rejects(spark, lake, run_date, options)
    if source == CLAIMS:
        raw = load_claims(spark, lake, options.fmt)
    else:
        raw = load_layer(spark, lake, BRONZE, source, options.fmt)
    df = options.consolidate(raw, source, run_date)
    return save_layer(df, lake, SILVER, source, options.fmt, by_log=options.by_log)


def _silver_or_rejects(
    spark: SparkSession, lake: str, run_date: datetime.date | str | None, options: Options
) -> int:
    """Silver policies, or else the table of rejects: one pass over the bronze table writes both
    to the staged table, in partitions of their own."""
    if options.date_mode != "strict":
        raise ValueError("rejects are kept of strict dates only")
    raw = load_layer(spark, lake, BRONZE, CORE, options.fmt)
    file, row = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    if options.fmt == "parquet":
        file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    raw = raw.withColumns({"BRONZE_FILE": file, "BRONZE_ROW": row})
    df = consolidate_core_strict(raw, run_date, options.blank_ruc_is_null, _ORIGIN)
    df = df.withColumn(_REJECTED, F.col("FAULTS") != 0)

    def refuse_rejects(written: DataFrame, _: int) -> None:
        rejected = written.where(F.col(_REJECTED).cast("boolean")).select(
            *[c for c in S.CONSOLIDATED_COLUMNS if c not in (*S.CORE_DATE_COLUMNS, "F_OCURRENCIA")],
            "FAULTY_DATES.*", "FAULTS", *_ORIGIN)
        bits = [F.sum(F.getbit("FAULTS", F.lit(i)).cast("bigint")).alias(name)
                for i, name in enumerate(S.CORE_DATE_COLUMNS)]
        counts = rejected.agg(F.count(F.lit(1)).alias("policies"), *bits).first().asDict()
        if counts["policies"]:
            save_layer(rejected, lake, REJECTS, CORE, options.fmt, by_log=options.by_log)
            raise RejectedRows(counts, layer_path(lake, REJECTS, CORE))

    return save_layer(df, lake, SILVER, CORE, options.fmt, refuse_rejects, _REJECTED,
                      options.by_log)


def export_gold(
    spark: SparkSession, lake: str, reports: str, source: str,
    run_date: datetime.date | str, options: Options = Options(),
) -> int:
    """Report of the silver table of ``source``, in document order."""
    df = load_layer(spark, lake, SILVER, source, options.fmt)
    # Parquet knows the number of a row; other formats give the session's.
    row = (F.col("_metadata.row_index") if options.fmt == "parquet"
           else F.monotonically_increasing_id())
    df = df.withColumn(_ROW, row).select(*S.CONSOLIDATED_COLUMNS, _ROW)
    df = _in_document_order(df, _sort_ranges(df))
    path = f"{reports.rstrip('/')}/{report_name(_BASES[source], run_date)}"
    return write_report(df, path, options.drop_optional, by_log=options.by_log)


def _sort_ranges(reports: DataFrame) -> int:
    """Number of ranges for sorting Parquet reports.

    It follows from their rows, which are counted in the file footers, and from
    the size of a row before compression; not from the session's shuffle
    partitions, which adaptive execution can merge but not divide. Small reports
    still give every core a range.
    """
    size = reports.count() * _RAW_ROW_BYTES
    return max(size // _RANGE_BYTES + 1, reports.sparkSession.sparkContext.defaultParallelism)


def _in_document_order(numbered: DataFrame, partitions: int) -> DataFrame:
    """Document order of numbered rows, runs of copies spread as well."""
    return order_by_document(numbered, partitions, F.col(_ROW)).drop(_ROW)


def run_layers(
    spark: SparkSession,
    paths: Paths,
    layers: tuple[str, ...] = ALL_LAYERS,
    sources: tuple[str, ...] = ALL_SOURCES,
    run_date: datetime.date | str | None = None,
    options: Options = Options(),
) -> dict[tuple[str, str], int]:
    """Run the chosen layers for the chosen sources; rows by layer and source.

    Layers that are left out are taken from the lake. A later layer skips a
    source whose earlier table does not exist.
    """
    _check_choice(layers, ALL_LAYERS)
    _check_choice(sources, ALL_SOURCES)
    run_date = run_date or datetime.date.today()
    if BRONZE in layers:
        for source in sources:
            require_path(spark, getattr(paths, source), f"{source} folder")
    rows = {}
    for layer in [known for known in ALL_LAYERS if known in layers]:
        for source in sources:
            if layer == BRONZE:
                ingest = {CORE: ingest_core, CLAIMS: ingest_claims}[source]
                count = ingest(spark, getattr(paths, source), paths.lake, options)
            elif not layer_exists(spark, paths.lake, _previous(layer), source):
                log.warning("no %s table of %s, skipped", _previous(layer), source)
                continue
            elif layer == SILVER:
                count = build_silver(spark, paths.lake, source, run_date, options)
            else:
                count = export_gold(
                    spark, paths.lake, paths.reports, source, run_date, options)
            rows[layer, source] = count
    return rows


def _previous(layer: str) -> str:
    return ALL_LAYERS[ALL_LAYERS.index(layer) - 1]


def _check_choice(chosen: tuple[str, ...], known: tuple[str, ...]) -> None:
    unknown = [name for name in chosen if name not in known]
    if unknown or not chosen:
        raise ValueError(f"choose from {known}, not {chosen}")


# --- jobs without layers -------------------------------------------------

def run_direct(
    spark: SparkSession,
    paths: Paths,
    sources: tuple[str, ...] = ALL_SOURCES,
    run_date: datetime.date | str | None = None,
    options: Options = Options(),
) -> dict[str, int]:
    """Reports straight from the source folders; rows by source."""
    _check_choice(sources, ALL_SOURCES)
    if options.keep_rejects:
        raise ValueError("rejects are kept by layered runs only")
    run_date = run_date or datetime.date.today()
    for source in sources:
        require_path(spark, getattr(paths, source), f"{source} folder")
    require_path(spark, paths.reports, "report folder")
    rows = {}
    for source in sources:
        path = f"{paths.reports.rstrip('/')}/{report_name(_BASES[source], run_date)}"
        if source == CORE:
            df = options.consolidate(options.read(spark, paths.core), source, run_date)
            rows[source] = write_report(df, path, options.drop_optional, by_log=options.by_log)
            continue
        # Workbooks are parsed once, into a table that is gone after the run, and checked
        # before a report is made of them.
        staged = staging_path(path)
        try:
            read_workbooks(spark, paths.claims).write.parquet(staged)
            parsed = spark.read.parquet(staged)
            require_claims(parsed)
            df = options.consolidate(claims_rows(parsed), source, run_date)
            rows[source] = write_report(df, path, options.drop_optional, by_log=options.by_log)
        finally:
            discard(spark, staged)
    return rows


def reprocess_reports(spark: SparkSession, reports: str, target: str) -> int:
    """All consolidated reports with the last document digit, as one report.

    ``target`` must be another folder than ``reports``, else the next run
    would read its own result. The name follows the last report's.
    """
    if target.rstrip("/") == reports.rstrip("/"):
        raise ValueError("reprocessed reports need a folder of their own")
    name = report_paths(spark, reports)[-1].rsplit("/", 1)[-1]
    df = add_last_digit(read_consolidated(spark, reports))
    return write_report(df, f"{target.rstrip('/')}/{reprocessed_name(name)}")


def sort_reports(
    spark: SparkSession, reports: str, target: str, partitions: int | None = None,
    lookup: bool = False,
) -> int:
    """All consolidated reports as one, in document order.

    ``partitions`` is the number of ranges; by default it follows from the
    rows of the reports. ``lookup`` prepares the report for find_documents.
    """
    df = read_reports(spark, reports, row_number=_ROW)
    df = _in_document_order(df, partitions or _sort_ranges(df))
    path = f"{target.rstrip('/')}/{SORTED_REPORT_NAME}"
    return write_report(df, path, row_group_rows=S.ROW_GROUP_ROWS_SORTED,
                        lookup_by="NRO_DOCUMENTO" if lookup else None)
