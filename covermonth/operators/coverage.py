"""Cover dates: parsing, cleaning and one row per covered month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.dates import (
    DEFAULT_YEAR_PIVOT,
    coverage_bounds,
    day_first_date,
    is_placeholder,
    is_valid_date,
    parse_date_strict,
    whole_months_between,
    with_parsed_dates,
)
from covermonth.plans.barrier import stage_barrier


def parse_dates(
    df: DataFrame,
    columns: list[str] = S.CORE_DATE_COLUMNS,
    mode: str = "lenient",
    year_pivot: int = DEFAULT_YEAR_PIVOT,
) -> DataFrame:
    """Turn date texts into dates, alike at any number of rows.

    ``lenient`` accepts eight formats and gives NULL otherwise; ``strict``
    accepts d/m/Y and fails otherwise.
    """
    if mode == "lenient":
        return with_parsed_dates(df, columns, year_pivot)
    if mode == "strict":
        return df.withColumns({c: parse_date_strict(F.col(c)) for c in columns})
    raise ValueError(f"unknown date mode: {mode}")


def split_off_date_faults(
    df: DataFrame, columns: list[str] = S.CORE_DATE_COLUMNS
) -> DataFrame:
    """Strict dates that do not fail: each row tells which of its texts are no d/m/Y dates.

    FAULTS has bit i set if the i-th of ``columns`` is not NULL and does not fit (0: a good
    row). FAULTY_DATES holds the texts of a row with a fault and is NULL otherwise; where a
    text does not fit, its date is NULL. No row is added or dropped.
    """
    parsed = {f"_date_{c}": day_first_date(F.col(c)) for c in columns}
    df = stage_barrier(df.withColumns(parsed))
    faults = F.lit(0)
    for i, name in enumerate(columns):
        no_date = F.col(name).isNotNull() & F.col(f"_date_{name}").isNull()
        faults = faults.bitwiseOR(F.when(no_date, F.lit(1 << i)).otherwise(F.lit(0)))
    df = df.withColumn("FAULTS", faults)
    df = df.withColumn("FAULTY_DATES", F.when(F.col("FAULTS") != 0, F.struct(*columns)))
    df = df.withColumns({c: F.col(f"_date_{c}") for c in columns})
    return df.drop(*parsed)


def clear_placeholder_ends(df: DataFrame) -> DataFrame:
    """Far-future placeholder end dates become NULL."""
    end = F.col("F_FIN_COBERT")
    return df.withColumn("F_FIN_COBERT", F.when(~is_placeholder(end), end))


def date_range_filter(df: DataFrame, spared: Column | None = None) -> DataFrame:
    """Require a valid start; end and cancellation may be missing.

    Rows for which ``spared`` is true stay whatever their dates.
    """
    end, cancelled = F.col("F_FIN_COBERT"), F.col("F_ANULACION_CERT")
    in_range = (
        is_valid_date(F.col("F_INI_COBER"))
        & (end.isNull() | is_valid_date(end))
        & (cancelled.isNull() | is_valid_date(cancelled))
    )
    return df.where(in_range if spared is None else spared | in_range)


def add_coverage_bounds(df: DataFrame) -> DataFrame:
    """Add the first and last covered day as _FIRST and _LAST."""
    first, last = coverage_bounds(F.col("F_INI_COBER"), F.col("F_FIN_COBERT"))
    return df.withColumns({"_FIRST": first, "_LAST": last})


def expand_months(df: DataFrame, unbounded: Column | None = None) -> DataFrame:
    """One row per month from _FIRST to _LAST, dated F_OCURRENCIA.

    Rows for which ``unbounded`` is true stay one row, without a date.

    Month numbers are generated and added to the first day: a sequence of
    integers is much cheaper than one of dates, which goes through time-zone
    arithmetic for each element.
    """
    months = whole_months_between(F.col("_FIRST"), F.col("_LAST"))
    if unbounded is None:
        df = df.withColumn("_month", F.explode(F.sequence(F.lit(0), months)))
    else:
        steps = F.when(~unbounded, F.sequence(F.lit(0), months))
        df = df.where(unbounded | months.isNotNull()).withColumn("_month", F.explode_outer(steps))
    occurrence = F.add_months(F.col("_FIRST"), F.col("_month"))
    return df.withColumn("F_OCURRENCIA", occurrence).drop("_FIRST", "_LAST", "_month")
