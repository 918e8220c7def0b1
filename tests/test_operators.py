"""Operators on hand-made rows."""

from __future__ import annotations

import calendar
import datetime
import random

import pytest
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.dates import coverage_bounds
from covermonth.operators.claims import consolidate_claims
from covermonth.operators.core import consolidate_core
from covermonth.operators.coverage import add_coverage_bounds, expand_months, parse_dates
from covermonth.operators.documents import pad_documents, resolve_documents
from covermonth.operators.reports import add_last_digit, order_by_document, union_bases
from covermonth.operators.shift import shift_repair

D = datetime.date


def policy(**fields):
    row = {name: name.lower() for name in S.CORE_COLUMNS}
    row.update(DNI_ASEGURADO="12345678", RUC_ASEGURADO=None, F_ANULACION_CERT=None,
               F_INI_COBER="01/01/2020", F_FIN_COBERT="31/03/2020")
    row.update(fields)
    return tuple(row[name] for name in S.CORE_COLUMNS)


def policies(spark, *rows):
    return spark.createDataFrame([policy(**row) for row in rows], S.CORE_SCHEMA)


def test_shift_by_one(spark):
    for ruc in ("12345678", None, "CE123", "CECILIA"):
        row = shift_repair(policies(spark, {"DNI_ASEGURADO": "PEREZ", "RUC_ASEGURADO": ruc})).first()
        assert row.CONTRATANTE == "contratante"
        assert row.ASEGURADO == "asegurado PEREZ"
        assert row.DNI_ASEGURADO == ruc
        assert row.RUC_ASEGURADO == "f_emision_poliza"
        assert row.F_ANULACION_CERT == "01/01/2020"
        assert row.F_INI_COBER == "31/03/2020"
        assert (row.F_FIN_COBERT, row.PARENTESCO, row.FI) == ("parentesco", "fi", None)


def test_shift_by_two(spark):
    row = shift_repair(policies(spark, {
        "DNI_ASEGURADO": "PEREZ", "RUC_ASEGURADO": "GOMEZ", "F_ANULACION_CERT": "cancelled",
    })).first()
    assert row.CONTRATANTE == "contratante asegurado"
    assert row.ASEGURADO == "PEREZ GOMEZ"
    assert (row.DNI_ASEGURADO, row.RUC_ASEGURADO) == ("f_emision_poliza", "f_emision_cert")
    assert (row.F_EMISION_POLIZA, row.F_EMISION_CERT) == ("f_ini_poliza", "f_fin_poliza")
    assert (row.F_INI_POLIZA, row.F_FIN_POLIZA) == ("cancelled", "01/01/2020")
    assert row.F_ANULACION_CERT == "31/03/2020"
    assert row.F_INI_COBER == "cancelled"
    assert (row.F_FIN_COBERT, row.PARENTESCO, row.FI) == ("parentesco", "fi", None)


def test_no_shift(spark):
    for dni, ruc in (("12345678", None), (None, "GOMEZ"), ("PEREZ", "X-1"), ("PEREZ", "")):
        row = shift_repair(policies(spark, {"DNI_ASEGURADO": dni, "RUC_ASEGURADO": ruc})).first()
        assert (row.DNI_ASEGURADO, row.RUC_ASEGURADO, row.FI) == (dni, ruc, "fi")


def test_blank_tax_id_may_count_as_missing(spark):
    df = policies(spark, {"DNI_ASEGURADO": "PEREZ", "RUC_ASEGURADO": ""})
    assert shift_repair(df, blank_ruc_is_null=True).first().ASEGURADO == "asegurado PEREZ"


def test_joined_names_are_null_if_a_part_is(spark):
    row = shift_repair(policies(spark, {"DNI_ASEGURADO": "PEREZ", "ASEGURADO": None})).first()
    assert row.ASEGURADO is None


@pytest.mark.parametrize(("dni", "ruc", "expected"), [
    (None, "20123456789", ("20123456789", "RUC")), ("12345678", None, ("12345678", "DNI")),
    ("12345", None, ("00012345", "DNI")), ("123456789", None, ("123456789", "DNI")),
    (None, "123", ("123", "RUC")), ("20123456789", "10123456789", ("10123456789", "RUC")),
    ("12345678", "10123456789", ("12345678", "DNI")), ("123456789", "10123456789", (None, None)),
    ("PAS12", None, ("PAS12", "DNI")), (None, "CE12", ("CE12", "DNI")),
    (None, "C.E12", ("C.E12", "DNI")), ("PAS12", "10123456789", (None, None)),
    ("X-1", None, (None, None)), ("", "20123456789", ("20123456789", "RUC")),
    ("12345678", "", ("12345678", "DNI")), (None, None, (None, None)),
    ("12345678", "CE1", (None, None)), ("-123456", None, (None, None)),
])
def test_document_resolution(spark, dni, ruc, expected):
    df = policies(spark, {"DNI_ASEGURADO": dni, "RUC_ASEGURADO": ruc})
    row = resolve_documents(pad_documents(df)).first()
    assert (row.NRO_DOCUMENTO, row.TIPO_DOC) == expected


# --- cover ---------------------------------------------------------------

def next_first(day):
    return D(day.year + day.month // 12, day.month % 12 + 1, 1)


def add_months(day, n):
    year, month = divmod(day.year * 12 + day.month - 1 + n, 12)
    return D(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def expected_months(start, end):
    """Cover written out day by day, without the library's expressions."""
    entry = start if start.day == 1 else next_first(start)
    first = entry
    if end is not None and (end == start or (
            (end - start).days <= 30 and start.month >= end.month)):
        first = start
    valid_end = end is not None and start <= end <= add_months(start, 85 * 12)
    last = end if valid_end else entry
    months, n = [], 0
    while add_months(first, n) <= last:
        months.append(add_months(first, n))
        n += 1
    return months


def edge_covers():
    pairs = [
        (D(2020, 1, 1), None), (D(2020, 1, 15), None), (D(2020, 1, 15), D(2020, 1, 15)),
        (D(2020, 1, 15), D(2019, 12, 1)), (D(2020, 3, 15), D(2020, 3, 20)),
        (D(2020, 1, 15), D(2020, 2, 10)), (D(2020, 12, 15), D(2021, 1, 10)),
        (D(2020, 1, 31), D(2020, 2, 29)), (D(2020, 1, 1), D(2105, 1, 1)),
        (D(2020, 1, 1), D(2105, 1, 2)), (D(2020, 2, 29), D(2105, 2, 28)),
        (D(2020, 2, 29), D(2105, 3, 1)), (D(2020, 12, 1), D(2020, 12, 31)),
        (D(2020, 5, 20), D(2018, 1, 2)),
    ]
    chance = random.Random(7)
    for _ in range(1500):
        start = D(1990, 1, 1) + datetime.timedelta(days=chance.randrange(20000))
        pairs.append((start, start + datetime.timedelta(days=chance.randrange(-60, 800))))
    return pairs


def test_months_against_brute_force(spark):
    pairs = edge_covers()
    df = spark.createDataFrame(
        [(i, s, e) for i, (s, e) in enumerate(pairs)], "i int, F_INI_COBER date, F_FIN_COBERT date")
    found = {}
    for row in expand_months(add_coverage_bounds(df)).select("i", "F_OCURRENCIA").collect():
        found.setdefault(row.i, []).append(row.F_OCURRENCIA)
    for i, (start, end) in enumerate(pairs):
        assert sorted(found[i]) == expected_months(start, end), (start, end)


def test_bounds_are_ordered(spark):
    df = spark.createDataFrame(edge_covers(), "s date, e date")
    first, last = coverage_bounds(F.col("s"), F.col("e"))
    assert df.where(first > last).isEmpty()


def test_date_modes(spark):
    df = spark.createDataFrame([("2020-01-31",), ("31/01/2020",)], "d string")
    assert [str(r.d) for r in parse_dates(df, ["d"]).collect()] == ["2020-01-31"] * 2
    with pytest.raises(Exception, match="not a d/m/Y date"):
        parse_dates(df, ["d"], "strict").collect()
    with pytest.raises(ValueError, match="unknown date mode"):
        parse_dates(df, ["d"], "auto")


def test_core_rows(spark):
    df = policies(
        spark, {}, {"F_INI_COBER": "N/A"}, {"F_INI_COBER": "01/01/1800"},
        {"F_FIN_COBERT": "2103-06-19", "POLIZA": "open"}, {"DNI_ASEGURADO": "X-1"},
        {"F_ANULACION_CERT": "01/01/1700"},
    )
    rows = consolidate_core(df, D(2024, 1, 1)).collect()
    found = sorted((r.POLIZA, r.F_OCURRENCIA.month, str(r.F_FIN_COBERT)) for r in rows)
    assert found == [("open", 1, "None")] + [("poliza", m, "2020-03-31") for m in (1, 2, 3)]
    assert {r.BASE for r in rows} == {"CORE"}
    assert {r.FECHA_REGISTRO for r in rows} == {D(2024, 1, 1)}


def test_claims_are_distinct(spark):
    claim = ("1.234-567", "7", "P1", "C1", " ANA ", "15/01/2020")
    rows = [claim, claim, ("12", *claim[1:]), (None, *claim[1:]),
            (*claim[:5], "2200-02-03"), (*claim[:4], "AB", claim[5]), (*claim[:5], None)]
    df = spark.createDataFrame(rows, S.CLAIMS_SCHEMA)
    once = consolidate_claims(df, D(2024, 1, 1)).collect()
    assert len(once) == 1
    row = once[0]
    assert (row.NRO_DOCUMENTO, row.TIPO_DOC, row.ASEGURADO) == ("01234567", "DNI", "ANA")
    assert (row.F_INI_COBER, row.F_OCURRENCIA) == (D(2020, 1, 15), D(2020, 2, 1))
    assert (row.F_FIN_COBERT, row.F_ANULACION_CERT, row.PARENTESCO, row.FI) == (None,) * 4
    assert consolidate_claims(df.union(df), D(2024, 1, 1)).collect() == once


def test_default_registration_date_is_today(spark):
    row = consolidate_core(policies(spark, {})).first()
    assert row.FECHA_REGISTRO == spark.sql("SELECT current_date()").first()[0]


# --- reports -------------------------------------------------------------

def test_union_with_a_report_without_optional_columns(spark):
    core = consolidate_core(policies(spark, {}), "2024-01-01")
    both = union_bases(core, core.drop("PARENTESCO", "FI"))
    assert both.columns == S.CONSOLIDATED_COLUMNS
    assert both.where("FI IS NULL").count() == 3


def test_last_digit_column(spark):
    df = add_last_digit(consolidate_core(policies(spark, {}), "2024-01-01"))
    assert df.columns == S.REPROCESSED_COLUMNS
    assert df.schema["ULT_DIGI_DOC"].dataType.simpleString() == "tinyint"
    assert {r.ULT_DIGI_DOC for r in df.collect()} == {8}


def document_rows(spark, rows):
    return spark.createDataFrame(rows, "NRO_DOCUMENTO string, F_OCURRENCIA date, n int")


def test_order_and_nulls_last(spark):
    rows = [(str(i % 13) if i % 13 else None, D(2020, 1 + i % 12, 1) if i % 5 else None, i)
            for i in range(500)]
    df = order_by_document(document_rows(spark, rows), 4)
    found = [(r.NRO_DOCUMENTO, r.F_OCURRENCIA) for r in df.collect()]

    def nulls_last(row):
        return tuple((v is None, v or (D.min if k else "")) for k, v in enumerate(row))

    assert found == sorted(found, key=nulls_last)
    assert sorted(r.n for r in df.collect()) == list(range(500))


def test_a_hot_document_is_spread_over_ranges(spark):
    rows = [("hot", D(2020, 1, 1), i) for i in range(3000)]
    rows += [(str(i), D(2020, 1, 1), i) for i in range(6000)]
    df = order_by_document(document_rows(spark, rows).repartition(4), 6)
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 6
    assert max(r["count"] for r in sizes) < 3000
