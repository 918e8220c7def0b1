"""Date expressions: parsing, validity and covered months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.plans.barrier import stage_barrier

# A value is worth parsing if it is year-first with a four-digit year, or has
# three short parts whose last one may be a year; one separator throughout.
_DATE_SHAPE = (
    r"^(?:\d{4}([-/])\d{1,2}\1\d{1,2}"
    r"|\d{1,2}([-/])\d{1,2}\2(?:\d{4}|\d{1,2}))\z"
)
_DAY_FIRST_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4}\z"

DEFAULT_YEAR_PIVOT = 69


def _date_text(text: Column) -> Column:
    return F.substring(text, 1, 10)


def _reversed_parts(dashed: Column) -> Column:
    """``a-b-c`` becomes ``c-b-a``."""
    first = F.substring_index(dashed, "-", 1)
    middle = F.substring_index(F.substring_index(dashed, "-", 2), "-", -1)
    last = F.substring_index(dashed, "-", -1)
    return F.concat_ws("-", last, middle, first)


def _full_dates(text: Column) -> tuple[Column, Column]:
    """Dates of texts that begin like ``YYYY-mm-dd`` and like ``dd/mm/YYYY``; NULL for any other text.

    No regular expression is needed: the separators stand in their places, and the cast takes
    digits only, except after the day, where it would end at a blank or a T.
    """
    def at(place: int, length: int = 1) -> Column:
        return F.substring(text, place, length)

    def ends_in_digit(place: int) -> Column:
        return at(place).between("0", "9")

    year_first = (at(5) == "-") & (at(8) == "-") & ends_in_digit(10)
    day_first = (at(3) == "/") & (at(6) == "/") & ends_in_digit(2)
    turned = F.concat(at(7, 4), F.lit("-"), at(4, 2), F.lit("-"), at(1, 2))
    return (F.when(year_first, at(1, 10).try_cast("date")),
            F.when(day_first, turned.try_cast("date")))


def _has_four_digit_year(iso: Column) -> Column:
    return F.instr(iso, "-") == 5


def with_parsed_dates(
    df: DataFrame, columns: list[str], year_pivot: int = DEFAULT_YEAR_PIVOT
) -> DataFrame:
    """Lenient dates: the first of eight formats that fits, else NULL.

    The formats are, in order: Y-m-d, d/m/Y, d-m-Y, Y/m/d, then d/m/y, d-m-y,
    y/m/d, y-m-d. ``Y`` has four digits, ``y`` two; days and months have one or
    two. Two-digit years from ``year_pivot`` on belong to the 1900s. Only the
    first ten characters count.

    Trying the formats one after another would raise and swallow an exception
    inside the JVM for each format that does not fit. The formats differ in
    shape, so the text is instead brought into ISO order and cast. Only
    two-digit years leave a choice (day or year first), made by position in
    the list above. Texts of the two usual forms with all their digits take none
    of these steps. The steps are separate projections so that shared parts
    are computed once, and a barrier keeps the generated code small enough to compile.
    """

    def full_year(iso: Column) -> Column:
        century = F.when(F.left(iso, F.lit(2)) >= f"{year_pivot:02d}", "19").otherwise("20")
        return F.concat(century, iso)

    def cast(name: str) -> Column:
        dashed, swapped = F.col(name), F.col(f"_swapped_{name}")
        has_year = _has_four_digit_year(dashed) | _has_four_digit_year(swapped)
        iso = (
            F.when(_has_four_digit_year(dashed), dashed)
            .when(_has_four_digit_year(swapped), swapped)
            .otherwise(full_year(swapped))
        )
        year_first = F.when(~has_year, full_year(dashed).try_cast("date"))
        found = F.when(dashed.isNotNull(), F.coalesce(iso.try_cast("date"), year_first))
        return F.coalesce(F.col(f"_full_{name}"), found)

    def dashed_text(name: str) -> Column:
        text = _date_text(F.col(name))
        fits = F.col(f"_full_{name}").isNull() & text.rlike(_DATE_SHAPE)
        return F.when(fits, F.replace(text, F.lit("/"), F.lit("-")))

    def swapped_text(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), _reversed_parts(F.col(name)))

    full = {f"_full_{c}": F.coalesce(*_full_dates(F.col(c))) for c in columns}
    df = stage_barrier(df.withColumns(full))
    df = df.withColumns({c: dashed_text(c) for c in columns})
    df = df.withColumns({f"_swapped_{c}": swapped_text(c) for c in columns})
    df = df.withColumns({c: cast(c) for c in columns})
    return df.drop(*[f"_{step}_{c}" for step in ("full", "swapped") for c in columns])


def day_first_date(text: Column) -> Column:
    """Date in the one format d/m/Y; NULL for any other text."""
    _, full = _full_dates(text)
    text = _date_text(text)
    iso = _reversed_parts(F.replace(text, F.lit("/"), F.lit("-")))
    return F.coalesce(full, F.when(text.rlike(_DAY_FIRST_SHAPE), iso.try_cast("date")))


def parse_date_strict(text: Column) -> Column:
    """Date in the one format d/m/Y; any other text fails the query."""
    failure = F.raise_error(F.concat(F.lit("not a d/m/Y date: "), _date_text(text))).cast("date")
    return F.coalesce(day_first_date(text), F.when(text.isNotNull(), failure))


def is_placeholder(date: Column) -> Column:
    """True for the far-future dates that stand for "no end"."""
    return date.isin(*[F.lit(d).cast("date") for d in S.PLACEHOLDER_END_DATES])


def is_valid_date(date: Column) -> Column:
    return date.between(F.lit(S.MIN_VALID_DATE).cast("date"), F.lit(S.MAX_VALID_DATE).cast("date"))


def _entry_month(start: Column) -> Column:
    """The date itself on the 1st of a month, else the 1st of the next one."""
    return F.when(F.day(start) == 1, start).otherwise(F.date_add(F.last_day(start), 1))


def coverage_bounds(start: Column, end: Column) -> tuple[Column, Column]:
    """First and last covered day of a certificate, as two expressions.

    Cover normally counts from the first full month. It counts from the start
    date itself if cover lasts a single day or ends within 30 days without
    reaching a later month number. An end that is missing, before the start
    or more than 85 years after it leaves the entry month only.
    """
    short_cover = (F.datediff(end, start) <= 30) & (F.month(start) >= F.month(end))
    latest_end = F.add_months(start, 12 * S.MAX_COVER_YEARS)
    first_day = F.when((end == start) | short_cover, start).otherwise(_entry_month(start))
    last_day = F.when(end.between(start, latest_end), end).otherwise(_entry_month(start))
    return first_day, last_day


def whole_months_between(first: Column, last: Column) -> Column:
    """Number of monthly steps from ``first`` that do not pass ``last``."""
    months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
    return months - (F.day(last) < F.day(first)).cast("int")
