"""Identity documents: padding, resolution and the quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.text import (
    blank_to_null,
    is_all_digits,
    is_foreign_document,
    is_integer,
    is_text_only,
    pad_document,
)


def pad_documents(df: DataFrame) -> DataFrame:
    """Pad short national ids to eight digits; blank ids become NULL."""
    dni, ruc = F.col("DNI_ASEGURADO"), F.col("RUC_ASEGURADO")
    return df.withColumns({
        "DNI_ASEGURADO": blank_to_null(pad_document(dni, is_integer(dni))),
        "RUC_ASEGURADO": blank_to_null(ruc),
    })


def resolve_documents(df: DataFrame) -> DataFrame:
    """Choose NRO_DOCUMENTO and TIPO_DOC from the national and the tax id.

    One id alone is taken if it is numeric or marked as a foreign document.
    With two numeric ids, an 11-digit national id points to the tax id and an
    8-digit one to itself. Only numeric tax ids are of type RUC.
    """
    dni, ruc = F.col("DNI_ASEGURADO"), F.col("RUC_ASEGURADO")
    df = df.withColumns({
        "_dni_digits": is_all_digits(dni),
        "_ruc_digits": is_all_digits(ruc),
        "_dni_foreign": is_foreign_document(dni),
        "_ruc_foreign": is_foreign_document(ruc),
    })
    dni_digits, ruc_digits = F.col("_dni_digits"), F.col("_ruc_digits")
    both_digits = dni_digits & ruc_digits

    tax_number = (dni.isNull() & ruc_digits) | (
        both_digits & (F.length(dni) == S.TAX_ID_LENGTH))
    foreign_in_ruc = dni.isNull() & F.col("_ruc_foreign")
    national = (ruc.isNull() & (dni_digits | F.col("_dni_foreign"))) | (
        both_digits & (F.length(dni) == S.DOCUMENT_LENGTH))

    df = df.withColumn(
        "_choice",
        F.when(tax_number, "tax").when(foreign_in_ruc, "foreign").when(national, "national"),
    )
    choice = F.col("_choice")
    return df.withColumns({
        "NRO_DOCUMENTO": F.when(choice == "national", dni).when(choice.isNotNull(), ruc),
        "TIPO_DOC": F.when(choice == "tax", "RUC").when(choice.isNotNull(), "DNI"),
    }).drop(
        "DNI_ASEGURADO", "RUC_ASEGURADO", "_choice",
        "_dni_digits", "_ruc_digits", "_dni_foreign", "_ruc_foreign",
    )


def quality_filter(df: DataFrame) -> DataFrame:
    """Keep rows with a usable document and at least one cover date text."""
    return df.where(
        F.col("TIPO_DOC").isin("DNI", "RUC")
        & (F.col("F_INI_COBER").isNotNull() | F.col("F_FIN_COBERT").isNotNull())
        & ~is_text_only(F.col("NRO_DOCUMENTO"))
    )
