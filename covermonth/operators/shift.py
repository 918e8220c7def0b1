"""Repair of rows whose fields slid to the right."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.text import is_integer, is_text_only, strip
from covermonth.plans.barrier import stage_barrier


def strip_all(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strip white space from both ends of every column, or of ``columns`` only.

    A barrier follows, because the code of this step and the next one together would be too long
    to compile. Columns are not pruned through it.
    """
    stripped = df.columns if columns is None else columns
    return stage_barrier(df.select(*[
        strip(F.col(name)).alias(name) if name in stripped else name for name in df.columns]))


def _shift_flags(blank_ruc_is_null: bool) -> tuple[Column, Column]:
    """One extra name part (shift by one) and two of them (shift by two)."""
    dni, ruc = F.col("DNI_ASEGURADO"), F.col("RUC_ASEGURADO")
    no_ruc = ruc.isNull() | (ruc == "") if blank_ruc_is_null else ruc.isNull()
    by_one = is_text_only(dni) & (no_ruc | is_integer(ruc) | ruc.contains("CE"))
    by_two = is_text_only(dni) & is_text_only(ruc)
    return by_one, by_two


def _joined(*names: str) -> Column:
    """Name parts with a space between; NULL if any of them is NULL."""
    parts = [F.col(names[0])]
    for name in names[1:]:
        parts += [F.lit(" "), F.col(name)]
    return F.concat(*parts)


def _field_after_shift(name: str, steps: int) -> Column:
    """Where the value of ``name`` is found in a row shifted by ``steps``."""
    position = S.SHIFTABLE_COLUMNS.index(name) + steps
    if position >= len(S.SHIFTABLE_COLUMNS):
        return F.lit(None).cast("string")
    return F.col(S.SHIFTABLE_COLUMNS[position])


# Fields that do not simply come from the place ``steps`` further right: the
# names take up the parts that pushed the others away, and a shift by two is
# known to fill the last four fields in its own way.
_SHIFT_BY_ONE_EXCEPTIONS = {
    "CONTRATANTE": lambda: F.col("CONTRATANTE"),
    "ASEGURADO": lambda: _joined("ASEGURADO", "DNI_ASEGURADO"),
}
_SHIFT_BY_TWO_EXCEPTIONS = {
    "CONTRATANTE": lambda: _joined("CONTRATANTE", "ASEGURADO"),
    "ASEGURADO": lambda: _joined("DNI_ASEGURADO", "RUC_ASEGURADO"),
    "F_INI_COBER": lambda: F.col("F_ANULACION_CERT"),
    "F_FIN_COBERT": lambda: _field_after_shift("F_FIN_COBERT", 1),
    "PARENTESCO": lambda: _field_after_shift("PARENTESCO", 1),
}


def shift_repair(df: DataFrame, blank_ruc_is_null: bool = False) -> DataFrame:
    """Move slid fields back to their columns; other rows pass unchanged.

    Expects stripped text: a white-space-only id would count as a name.
    ``blank_ruc_is_null`` also shifts rows whose tax id is blank.
    """
    by_one, by_two = _shift_flags(blank_ruc_is_null)
    df = df.withColumn("_shift", F.when(by_one, 1).when(by_two, 2).otherwise(0))

    def repaired(name: str) -> Column:
        one = _SHIFT_BY_ONE_EXCEPTIONS.get(name, lambda: _field_after_shift(name, 1))()
        two = _SHIFT_BY_TWO_EXCEPTIONS.get(name, lambda: _field_after_shift(name, 2))()
        shift = F.col("_shift")
        return F.when(shift == 0, F.col(name)).when(shift == 1, one).otherwise(two)

    return df.withColumns({n: repaired(n) for n in S.SHIFTABLE_COLUMNS}).drop("_shift")
