"""Claims rows in the schema of the consolidated monthly table."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.dates import (
    DEFAULT_YEAR_PIVOT,
    is_placeholder,
    is_valid_date,
    with_parsed_dates,
)
from covermonth.functions.text import drop_document_noise, is_all_digits, pad_document
from covermonth.operators.core import registration_date
from covermonth.operators.coverage import add_coverage_bounds, expand_months
from covermonth.operators.shift import strip_all
from covermonth.plans.barrier import stage_barrier

_RENAMES = {"RAMO": "COD_RAMO", "DNI": "NRO_DOCUMENTO", "OCURRENCIA": "F_INI_COBER"}
_CLAIM_KEY = ["COD_RAMO", "POLIZA", "CERTIFICADO", "ASEGURADO", "NRO_DOCUMENTO", "F_INI_COBER"]


def clean_claims(df: DataFrame, year_pivot: int = DEFAULT_YEAR_PIVOT) -> DataFrame:
    """Usable claims with their six columns cleaned and renamed."""
    df = strip_all(df.select(*S.CLAIMS_COLUMNS))
    df = with_parsed_dates(df, ["OCURRENCIA"], year_pivot)
    df = stage_barrier(df.withColumn("DNI", drop_document_noise(F.col("DNI"))))
    dni, date = F.col("DNI"), F.col("OCURRENCIA")
    df = df.where(
        is_valid_date(date)
        & ~is_placeholder(date)
        & (F.length(dni) >= S.MIN_CLAIM_TEXT_LENGTH)
        & (F.length("ASEGURADO") >= S.MIN_CLAIM_TEXT_LENGTH)
    )
    df = df.withColumn("DNI", pad_document(dni, is_all_digits(dni)))
    return df.withColumnsRenamed(_RENAMES)


def with_claim_constants(df: DataFrame, run_date: datetime.date | str | None) -> DataFrame:
    """Add the columns that are the same for every claim."""
    return df.withColumns({
        "TIPO_DOC": F.lit("DNI"),
        "BASE": F.lit(S.BASE_CLAIMS),
        "F_ANULACION_CERT": F.lit(None).cast("date"),
        "F_FIN_COBERT": F.lit(None).cast("date"),
        "PARENTESCO": F.lit(None).cast("string"),
        "FI": F.lit(None).cast("string"),
        "FECHA_REGISTRO": registration_date(run_date),
    })


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct consolidated rows; NULLs count as equal."""
    return df.select(*S.CONSOLIDATED_COLUMNS).distinct()


def consolidate_claims(
    df: DataFrame,
    run_date: datetime.date | str | None = None,
    year_pivot: int = DEFAULT_YEAR_PIVOT,
) -> DataFrame:
    """Distinct consolidated monthly rows from raw claims rows.

    The other columns are constants or follow from six of them, so it is
    enough to make those six distinct: the one shuffle carries nothing else.
    Copies collapse within each task before the shuffle, so a claim that is
    repeated without end still sends one row per task.
    """
    df = clean_claims(df, year_pivot).select(*_CLAIM_KEY).distinct()
    df = expand_months(add_coverage_bounds(with_claim_constants(df, run_date)))
    return df.select(*S.CONSOLIDATED_COLUMNS)
