"""Policy rows to one row per certificate and covered month."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.dates import DEFAULT_YEAR_PIVOT
from covermonth.operators.coverage import (
    add_coverage_bounds,
    clear_placeholder_ends,
    date_range_filter,
    expand_months,
    parse_dates,
    split_off_date_faults,
)
from covermonth.operators.documents import pad_documents, quality_filter, resolve_documents
from covermonth.operators.shift import shift_repair, strip_all
from covermonth.plans.barrier import stage_barrier

_DOCUMENT_STAGE_COLUMNS = [
    "COD_RAMO", "POLIZA", "CERTIFICADO", "ASEGURADO", "TIPO_DOC", "NRO_DOCUMENTO",
    "F_INI_COBER", "F_FIN_COBERT", "F_ANULACION_CERT", "PARENTESCO", "FI",
]
# Even a shift moves these into columns only that the result does not have.
_UNREAD_COLUMNS = ["CONTRATANTE", "F_INI_POLIZA", "F_FIN_POLIZA"]


def registration_date(run_date: datetime.date | str | None) -> Column:
    """Date stamped on every row: the given one, else today."""
    return F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")


def clean_core(df: DataFrame, blank_ruc_is_null: bool = False) -> DataFrame:
    """Raw policy rows with fields repaired and documents resolved."""
    unread = {name: F.lit(None).cast("string") for name in _UNREAD_COLUMNS}
    df = strip_all(df.drop(*S.CORE_UNUSED_COLUMNS).withColumns(unread), S.CORE_COLUMNS)
    df = resolve_documents(pad_documents(shift_repair(df, blank_ruc_is_null)))
    extra = [c for c in df.columns if c not in S.CORE_COLUMNS + _DOCUMENT_STAGE_COLUMNS]
    return stage_barrier(df.select(*_DOCUMENT_STAGE_COLUMNS, *extra))


def consolidate_core(
    df: DataFrame,
    run_date: datetime.date | str | None = None,
    date_mode: str = "lenient",
    year_pivot: int = DEFAULT_YEAR_PIVOT,
    blank_ruc_is_null: bool = False,
) -> DataFrame:
    """Consolidated monthly rows from raw policy rows.

    Needs no shuffle: every step works within the scan's partitions. Columns
    beyond the 20 raw ones are ignored.
    """
    df = quality_filter(clean_core(df.select(*S.CORE_COLUMNS), blank_ruc_is_null))
    df = parse_dates(df, mode=date_mode, year_pivot=year_pivot)
    df = date_range_filter(stage_barrier(clear_placeholder_ends(df)))
    df = expand_months(add_coverage_bounds(df))
    return _with_core_constants(df, run_date).select(*S.CONSOLIDATED_COLUMNS)


def _with_core_constants(df: DataFrame, run_date: datetime.date | str | None) -> DataFrame:
    return df.withColumns({
        "BASE": F.lit(S.BASE_CORE),
        "FECHA_REGISTRO": registration_date(run_date),
    })


def consolidate_core_strict(
    df: DataFrame,
    run_date: datetime.date | str | None = None,
    blank_ruc_is_null: bool = False,
    origin: tuple[str, ...] = (),
) -> DataFrame:
    """Monthly rows under strict dates and, in the same pass, the policies that break them.

    The consolidated columns, FAULTS, FAULTY_DATES (see split_off_date_faults) and the
    columns of ``origin``, which say where a raw row comes from. Rows with FAULTS 0 are
    those of ``consolidate_core`` in strict mode. A policy with faults is one row, without
    F_OCURRENCIA; a policy that the quality filter drops has its dates read by nobody.
    """
    df = quality_filter(clean_core(df.select(*S.CORE_COLUMNS, *origin), blank_ruc_is_null))
    df = stage_barrier(split_off_date_faults(df))
    faulty = F.col("FAULTS") != 0
    df = date_range_filter(stage_barrier(clear_placeholder_ends(df)), spared=faulty)
    df = expand_months(add_coverage_bounds(df), unbounded=faulty)
    df = _with_core_constants(df, run_date)
    return df.select(*S.CONSOLIDATED_COLUMNS, "FAULTS", "FAULTY_DATES", *origin)
