"""Edge values of the text and date functions, expected by hand."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from covermonth.functions import text as T
from covermonth.functions.dates import (
    _full_dates,
    day_first_date,
    parse_date_strict,
    with_parsed_dates,
)


def test_strip_removes_any_white_space(values):
    texts = ["\t a b \n", "\xa0x ", "　 ", "", None, "​z", "Ñ "]
    assert values(texts, T.strip) == ["a b", "x", "", "", None, "​z", "Ñ"]


def test_text_only(values):
    texts = ["PEREZ", "MUÑOZ DÍAZ", "A1", "", None, "a\xa0b", "ÜBER", "A\n"]
    assert values(texts, T.is_text_only) == [True, True, False, False, None, True, False, True]


def test_all_digits(values):
    texts = ["0123", "12a", "", None, "١٢", "12\n", "-1"]
    assert values(texts, T.is_all_digits) == [True, False, False, None, True, False, False]


def test_integer(values):
    texts = ["12", "+12", "-12", "5.0", "9223372036854775808", "", None, "1e3"]
    expected = [True, True, True, False, False, False, False, False]
    assert values(texts, T.is_integer) == expected


def test_foreign_documents(values):
    texts = ["PAS123", "CE9", "C.E. 9", "CXE", None]
    assert values(texts, T.is_foreign_document) == [True, True, True, False, None]


def test_pad_document(values):
    texts = ["12345", "1234567", "1234", "12345678", "+1234", "-123456", "12a45", "", None]
    expected = ["00012345", "01234567", "1234", "12345678", "+0001234", "-0123456", "12a45", "",
                None]
    assert values(texts, lambda x: T.pad_document(x, T.is_integer(x))) == expected


def test_document_noise(values):
    texts = [" 1.2.3-5 ", "CE-12", "ñ/Á", ".", None]
    assert values(texts, T.drop_document_noise) == ["1235", "CE12", "ñÁ", "", None]


def test_last_digit_and_blank(values):
    texts = ["1234", "123X", "", None, "7"]
    assert values(texts, T.last_digit) == [4, None, None, None, 7]
    assert values(texts, T.blank_to_null) == ["1234", "123X", None, None, "7"]


@pytest.mark.parametrize(("text", "expected"), [
    ("2020-01-31", "2020-01-31"), ("31/01/2020", "2020-01-31"), ("31-01-2020", "2020-01-31"),
    ("2020/01/31", "2020-01-31"), ("31/01/20", "2020-01-31"), ("31-01-20", "2020-01-31"),
    ("20/01/31", "2031-01-20"), ("20-01-31", "2031-01-20"), ("99/01/31", "1999-01-31"),
    ("68/1/2", "2068-01-02"), ("1/2/68", "2068-02-01"), ("1/2/69", "1969-02-01"),
    ("31/02/2020", None), ("29/02/2020", "2020-02-29"), ("29/02/2021", None),
    ("2020-01-31 10:00", "2020-01-31"), ("2020-1-3", "2020-01-03"), ("1/2/2020", "2020-02-01"),
    ("1/2/2020 10:00", None), ("", None), (None, None), ("31/01-2020", None),
    ("20200131", None), ("2020-01", None), ("1/2/202", None), ("02020-01-01", None),
    ("31/1/1997", "1997-01-31"), ("sin fecha", None), ("2020-13-01", None), ("1/2/3", None),
])
def test_lenient_dates(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    value = with_parsed_dates(df, ["d"]).first().d
    assert (value and value.isoformat()) == expected


def test_year_pivot(spark):
    df = spark.createDataFrame([("1/2/50",)], "d string")
    assert with_parsed_dates(df, ["d"], year_pivot=50).first().d.year == 1950
    assert with_parsed_dates(df, ["d"], year_pivot=51).first().d.year == 2050


def test_strict_dates(values):
    texts = ["31/01/2020 00:00", "1/2/2020", None]
    expected = [datetime.date(2020, 1, 31), datetime.date(2020, 2, 1), None]
    assert values(texts, parse_date_strict) == expected


@pytest.mark.parametrize("text", ["2020-01-31", "31/02/2020", "x", ""])
def test_strict_dates_fail(values, text):
    with pytest.raises(Exception, match="not a d/m/Y date"):
        values([text], parse_date_strict)


def test_visible_ends_are_kept_without_a_search(values):
    texts = ["x", "", None, "ñ", "a　", "\x1ca", "a b", "~", "\x7f", " !", " x\x85"]
    kept = ["x", "", None, "ñ", "a", "\x1ca", "a b", "~", "\x7f", "!", "x"]
    assert values(texts, T.strip) == kept
    # The list of all blanks is searched only for texts that need it.
    assert "CASE WHEN" in T.strip(F.col("x"))._jc.toString()
    assert values(["1.2-3", " 7. ", None, "12"], T.drop_document_noise) == ["123", "7", None, "12"]


def test_full_dates_take_no_regular_expression(spark):
    days = {"2020-01-05": 5, "05/01/2020": 5, "05/01/2020 10:00": 5, "2020-01-05T": 5,
            "5 /01/2020": None, "1T/01/2020": None, "2020-01-5 ": None, "2020-01-5T": None,
            " 5/01/2020": None, "05/ 1/2020": None, "05//1/2020": None, "-5/01/2020": None,
            "05/01/-020": None, "+020-01-05": None, "31/02/2020": None, "05/01/20": 5, "": None,
            "2020-1 -05": None, "05/01/20 x": None, "0٥/01/2020": None}
    df = spark.createDataFrame([(t, t, d) for t, d in days.items()], "x string, t string, d int")
    found = with_parsed_dates(df, ["x"])
    assert found.where("NOT (day(x) <=> d)").collect() == []
    strict = df.select("t", "d", day_first_date(F.col("t")).alias("x"))
    day_first = F.col("t").rlike(r"^\d{2}/\d{2}/\d{4}") & F.col("d").isNotNull()
    assert strict.where(~F.expr("day(x)").eqNullSafe(F.when(day_first, F.col("d")))).collect() == []
    # Both usual forms are read without the regular expression of the others.
    usual = df.where("t IN ('2020-01-05', '05/01/2020')").select(F.coalesce(*_full_dates(F.col("t"))))
    assert [r[0].day for r in usual.collect()] == [5, 5]
    assert "RLIKE" not in str(_full_dates(F.col("t")))
