"""Policy CSV folders: file audit, line repair and reading.

Files come from many hands: delimiter, encoding, width and quoting differ from
file to file. The first line of each file tells its delimiter and width; it is read
by the inventory of the folders, which also finds the files that Spark would not
see. One scan then reads all files, split at any line, and every line meets the layout of its
file. Encoding and quoting are looked at line by line. Sources
are never rewritten: damaged lines are repaired while they are read.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.plans.barrier import stage_barrier
from covermonth.sources.inventory import EMPTY, HIDDEN, OTHER, READ, source_files
from covermonth.sources.quoted_records import quoted_records

log = logging.getLogger(__name__)

# Separator that no line contains, so that a line is read as one field.
_NO_SEPARATOR = "\x01\x02"
_LISTED_FILES = 20
# Files whose layouts are broadcast, some hundred bytes each; more are met by a shuffle.
_BROADCAST_FILES = 500_000


@dataclass(frozen=True)
class CsvLayout:
    """How the files of one group are to be read.

    ``utf8``: all lines are known to be valid UTF-8; else they are checked one
    by one. ``wrapped``: lines may stand in outer quotes, or have an odd number of
    quotes; each is looked at by itself.
    ``repair_all``: stray and doubled quotes are repaired in every line.
    ``quoted_newlines``: quoted fields contain line breaks. This is never guessed
    from the data: one stray quote would swallow all lines after it.
    """

    delimiter: str = ","
    width: int = len(S.CORE_COLUMNS)
    utf8: bool = False
    wrapped: bool = False
    quoted_newlines: bool = False
    repair_all: bool = False


# --- lines ---------------------------------------------------------------

def decode_bytes(raw: Column) -> Column:
    """Text of a raw line: UTF-8 if it is valid, else ISO-8859-1."""
    return F.when(F.is_valid_utf8(raw), raw).otherwise(F.decode(raw.cast("binary"), "ISO-8859-1"))


def _decode_latin(text: Column) -> Column:
    """Undo a reading as ISO-8859-1 where the bytes are valid UTF-8."""
    raw = F.encode(text, "ISO-8859-1").cast("string")
    is_ascii = F.length(text) == F.octet_length(text)
    return F.when(is_ascii | ~F.is_valid_utf8(raw), text).otherwise(raw)


def _pattern(delimiter: str | Column, make: Callable[[str], str]) -> Column:
    """A regular expression for the delimiter; of a column, for that of each row."""
    if isinstance(delimiter, str):
        return F.lit(make(_escaped(delimiter)))
    return F.coalesce(*[F.when(delimiter == d, F.lit(make(_escaped(d)))) for d in S.CSV_DELIMITERS])


def _escaped(delimiter: str) -> str:
    return "\\" + delimiter if delimiter == "|" else delimiter


_Steps = list[tuple[str, Callable[[Callable[[str], Column]], Column]]]


def _cleaning(delimiter: str | Column, width: int | Column, every: bool) -> _Steps:
    """The steps of ``clean_line``: the name of each result, and how to get it from those before."""
    def matches(column: Column, make: Callable[[str], str]) -> Column:
        return F.regexp_substr(column, _pattern(delimiter, make)).isNotNull()

    def field(d: str) -> str:
        return f'(?:"(?:[^"]|"")*+"|[^"{d}]*+)'

    def bounded(get):
        return get("LINE").startswith('"') & get("LINE").endswith('"')

    def is_record(get):
        # The quotes around a line belong to its first and last field if the quoting is
        # without fault and gives several fields, or all fields stand in quotes, some
        # with a stray quote inside. Else the line as a whole was put in quotes.
        line = get("LINE")
        faultless = matches(line, lambda d: f"^{field(d)}(?:{d}{field(d)})+$")
        all_quoted = F.regexp_count(line, _pattern(delimiter, lambda d: f'"{d}(?=")')) == width - 1
        return get("_BOUNDED") & (faultless | (all_quoted & ~line.startswith('"""')))

    def plain(get):
        line = get("LINE")
        inner = F.substring(line, F.lit(2), F.length(line) - 2)
        return F.when(get("_BOUNDED") & ~get("_RECORD"), inner).otherwise(line)

    def single(get):
        pattern = _pattern(delimiter, lambda d: f'(^|{d})""(.+?)""(?={d}|$)')
        doubled = F.regexp_replace(get("_PLAIN"), pattern, F.lit('$1"$2"'))
        return F.when(get("_RECORD"), get("_PLAIN")).otherwise(doubled)

    def repaired(get):
        pattern = _pattern(delimiter, lambda d: f'(?<=[^"{d}])"(?=[^"{d}])')
        stray = F.regexp_replace(get("_SINGLE"), pattern, F.lit("'"))
        return F.when(get("_BOUNDED") | F.lit(every), stray).otherwise(get("_PLAIN"))

    def closed(get):
        pattern = _pattern(delimiter, lambda d: f'(^|{d})"(?!(?:[^"]|"")*+"(?:{d}|$))')
        found = F.regexp_replace(get("_REPAIRED"), pattern, F.lit("$1'"))
        return F.when(_has_odd_quotes(get("_REPAIRED")), found).otherwise(get("_REPAIRED"))

    return [("_BOUNDED", bounded), ("_RECORD", is_record), ("_PLAIN", plain), ("_SINGLE", single),
            ("_REPAIRED", repaired), ("LINE", closed)]


def clean_line(
    line: Column, delimiter: str = ",", width: int = len(S.CORE_COLUMNS), every: bool = True
) -> Column:
    """Repair the quoting of a line.

    Quotes around the whole line go. A field in doubled quotes then keeps single ones,
    and a quote inside a field becomes an apostrophe. Records of quoted fields
    keep their quotes. Lines not in quotes are repaired if ``every`` one is to be.
    A quote that opens a field and is closed nowhere becomes an apostrophe in any line.
    """
    results = {"LINE": line}
    for name, step in _cleaning(delimiter, width, every):
        results[name] = step(results.__getitem__)
    return F.when(line.contains('"'), results["LINE"]).otherwise(line)


def clean_lines(
    lines: DataFrame, delimiter: str | Column, width: int | Column, every: bool
) -> DataFrame:
    """``clean_line`` for LINE, each step a projection of its own.

    As one expression each step would name the one before several times, and
    the regular expressions would be evaluated over and over.
    """
    columns = lines.columns
    has_quote = F.col("LINE").contains('"')
    lines = lines.withColumn("_QUOTED", has_quote)
    for name, step in _cleaning(delimiter, width, every):
        otherwise = F.col("LINE") if name not in ("_BOUNDED", "_RECORD") else F.lit(False)
        lines = lines.withColumn(name, F.when(F.col("_QUOTED"), step(F.col)).otherwise(otherwise))
    return lines.select(*columns)


def _has_odd_quotes(line: Column) -> Column:
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    return quotes % 2 == 1


def raw_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Decoded data lines (LINE) of files with a header, and FILE, FOLDER.

    The CSV reader is used to skip the header of each file; it gets a
    separator that does not occur, and reads bytes one to one as ISO-8859-1.
    """
    lines = (
        spark.read.format("csv").schema("LINE string")
        .options(header=True, sep=_NO_SEPARATOR, quote="", encoding="ISO-8859-1")
        .load(paths)
    )
    return lines.select(_decode_latin(F.col("LINE")).alias("LINE"), *_lineage())


def _decode_uri(uri: Column) -> Column:
    """Spark gives file paths in URI notation."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(uri.contains("%"), decoded).otherwise(uri)


def _lineage(path: Column | None = None) -> list[Column]:
    """Names of the file and its folder."""
    path = F.col("_metadata.file_path") if path is None else path
    file = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return [_decode_uri(file).alias("FILE"), _decode_uri(folder).alias("FOLDER")]


# --- audit ---------------------------------------------------------------

def _delimiter_of(header: Column) -> Column:
    """The candidate that occurs most often; a comma if none does."""
    counts = [
        F.struct(
            F.regexp_count(header, F.lit("\\" + d if d == "|" else d)).alias("n"),
            F.lit(-i).alias("order"),
            F.lit(d).alias("d"),
        )
        for i, d in enumerate(S.CSV_DELIMITERS)
    ]
    return F.greatest(*counts)["d"]


def audit_csv_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per CSV file: header, layout and line counts.

    One pass over the lines. Line numbers within a file are not known, but ids
    grow from line to line of a split: the header is the line with the smallest
    id of a file's first split. Only the result is shuffled, one row per file
    and task.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    value = F.col("value")
    per_file = lines.groupBy("uri").agg(
        F.min_by("value", F.when(F.col("block") == 0, F.col("id"))).alias("header"),
        F.count_if(F.trim(value) != "").alias("LINES"),
        # A set, because aggregation of sets is hashed: the lines need no sort.
        F.collect_set(F.is_valid_utf8(value)).alias("utf8"),
        # Lines whose quoting has to be looked at.
        F.count_if((value.startswith('"') & value.endswith('"')) | _has_odd_quotes(value))
        .alias("QUOTED_LINES"),
    )
    per_file = stage_barrier(per_file.select(
        _decode_uri(F.col("uri")).alias("PATH"), *_lineage(F.col("uri")),
        "LINES", "QUOTED_LINES",
        (~F.array_contains("utf8", False)).alias("IS_UTF8"),
        decode_bytes(F.col("header")).alias("HEADER"),
    ))
    return _with_layout(per_file)


def _with_layout(files: DataFrame) -> DataFrame:
    """Files with DELIMITER and WIDTH, from their HEADER."""
    # Names in quotes are cut out, unless the header as a whole stands in quotes.
    header = F.trim("HEADER")
    names = F.regexp_replace(header, '"[^"]*"', "")
    inner = F.regexp_replace(
        F.substring(header, F.lit(2), F.length(header) - 2), '""[^"]*""', "")
    whole = header.startswith('"') & (names == "")
    files = files.withColumn("_names", F.when(whole, inner).otherwise(names))
    files = files.withColumn("DELIMITER", _delimiter_of(F.col("_names")))
    width = F.octet_length("_names") - F.octet_length(
        F.replace("_names", "DELIMITER", F.lit(""))) + 1
    return files.withColumn("WIDTH", width).drop("_names")


def _report(files: DataFrame, message: str) -> None:
    """Fail with the number of the given files and the first few, if there are any."""
    found = files.limit(_LISTED_FILES).collect()
    if found:
        listed = "\n".join(" | ".join(str(v) for v in row) for row in found)
        raise ValueError(f"{files.count()} {message}\n{listed}")


def _literal_path(path: str) -> str:
    """The path with glob characters escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def core_files(spark: SparkSession, root: str) -> DataFrame:
    """Inventory of the folders of ``root``, with HEADER, DELIMITER and WIDTH of CSV files."""
    files = source_files(spark, root, (".csv",), head=True)
    header = decode_bytes(F.col("HEAD").cast("string"))
    return _with_layout(files.withColumn("HEADER", header).drop("HEAD"))


def require_core_files(files: DataFrame, root: str) -> list[tuple[str, int]]:
    """Fail if a CSV file cannot be read as it is; warn of what is left aside.

    Files that start with _ or a dot, empty ones, ones without data rows and ones
    with a width other than 18 or 20 are errors. Other files are only named. Returns the
    delimiters and widths that occur.
    """
    full = len(S.CORE_COLUMNS)
    allowed = [full - len(S.CORE_OPTIONAL_COLUMNS), full]
    is_read = F.col("KIND") == READ
    problems = [
        ("CSV files start with _ or a dot, rename them:", F.col("KIND") == HIDDEN, ["PATH"]),
        ("empty CSV files:", F.col("KIND") == EMPTY, ["PATH"]),
        ("CSV files without data rows:",
         is_read & (~F.col("HAS_ROWS") | (F.trim("HEADER") == "")), ["PATH"]),
        (f"CSV files without {allowed} columns (expected {S.CORE_COLUMNS}):",
         is_read & ~F.col("WIDTH").isin(allowed), ["PATH", "WIDTH", "HEADER"]),
    ]
    # All guards in one pass; files are listed only if one of them finds some.
    by_folder = files.groupBy("FOLDER").agg(
        *[F.count_if(found).alias(f"problem{i}") for i, (_, found, _) in enumerate(problems)],
        F.count_if(is_read).alias("csv"), F.count_if(F.col("KIND") == OTHER).alias("other"),
        F.collect_set(F.when(is_read & F.col("WIDTH").isin(allowed),
                             F.struct("DELIMITER", "WIDTH"))).alias("layouts"))
    whole = by_folder.agg(
        *[F.sum(f"problem{i}") for i in range(len(problems))], F.sum("csv"),
        F.count_if((F.col("csv") == 0) | (F.col("other") > 0)), F.array_distinct(F.flatten(F.collect_set("layouts")))).first()
    *counts, csv, aside, layouts = whole
    if not csv and not any(counts):
        raise FileNotFoundError(f"no CSV files in the subfolders of {root}")
    for (message, found, columns), count in zip(problems, counts, strict=True):
        if count:
            _report(files.where(found).select(*columns), message)
    if aside:
        for row in by_folder.where("csv = 0 or other > 0").limit(_LISTED_FILES).collect():
            if row.csv == 0:
                log.warning("no CSV files in folder %s, skipped", row.FOLDER)
            else:
                log.warning("%d other files in folder %s, skipped", row.other, row.FOLDER)
    return sorted(tuple(layout) for layout in layouts)


# --- reading -------------------------------------------------------------

def core_pattern(root: str) -> str:
    """CSV files in the subfolders of ``root``."""
    return f"{_literal_path(root.rstrip('/'))}/*/[^._]*.[cC][sS][vV]"


def parse_lines(
    lines: DataFrame, columns: list[str], delimiter: str = ",", fail_fast: bool = False
) -> DataFrame:
    """Split LINE into string columns; other columns are kept.

    Surplus fields are cut and missing ones NULL, unless ``fail_fast``.
    """
    options = {
        "sep": delimiter, "escape": '"', "mode": "FAILFAST" if fail_fast else "PERMISSIVE",
    }
    ddl = ", ".join(f"`{c}` string" for c in columns)
    others = [c for c in lines.columns if c != "LINE"]
    return lines.select(F.inline(F.array(F.from_csv("LINE", ddl, options))), *others)


def _read_clean(
    spark: SparkSession, paths: list[str], layout: CsvLayout, columns: list[str], fail_fast: bool
) -> DataFrame:
    """Read files whose lines need no repair; the encoding may differ by field."""
    df = (
        spark.read.schema(S.all_strings(columns))
        .options(
            header=True, sep=layout.delimiter, escape='"', multiLine=layout.quoted_newlines,
            encoding="UTF-8" if layout.utf8 else "ISO-8859-1",
            mode="FAILFAST" if fail_fast else "PERMISSIVE",
        )
        .csv(paths)
    )
    fields = [F.col(c) if layout.utf8 else _decode_latin(F.col(c)).alias(c) for c in columns]
    return df.select(*fields, *_lineage())


def read_layout(
    spark: SparkSession, paths: list[str], layout: CsvLayout, fail_fast: bool = False
) -> DataFrame:
    """Policy rows of files with one layout, as strings, with FILE and FOLDER."""
    columns = S.CORE_COLUMNS[: layout.width]
    if layout.utf8 and not layout.wrapped and not layout.quoted_newlines:
        df = _read_clean(spark, paths, layout, columns, fail_fast)
        missing = {c: F.lit(None).cast("string") for c in S.CORE_COLUMNS[layout.width:]}
        df = df.withColumns(missing) if missing else df
        return df.select(*S.CORE_COLUMNS, "FILE", "FOLDER")
    lines = _lines(spark, paths, layout.quoted_newlines)
    if layout.wrapped and not layout.quoted_newlines:
        lines = clean_lines(lines, layout.delimiter, layout.width, layout.repair_all)
    return _parse_layouts(lines, [(layout.delimiter, layout.width)], fail_fast, layout.quoted_newlines)


def _lines(spark: SparkSession, paths: list[str], quoted_newlines: bool) -> DataFrame:
    """LINE, FILE and FOLDER of all records, still as text."""
    if not quoted_newlines:
        return raw_lines(spark, paths)
    records = quoted_records(spark, paths)
    line = decode_bytes(F.col("RECORD"))
    return records.select(line.alias("LINE"), *_lineage(F.col("uri")))


def _parse_layouts(
    lines: DataFrame, layouts: list[tuple[str, int]], fail_fast: bool, quoted_newlines: bool
) -> DataFrame:
    """Policy rows from LINE; of several layouts, DELIMITER and WIDTH say which is each line's."""
    # Where fields may hold line breaks, a record without all its fields is the sign
    # of a quote that was never closed.
    fail_fast = fail_fast or quoted_newlines
    options = {"escape": '"', "mode": "FAILFAST" if fail_fast else "PERMISSIVE"}
    if quoted_newlines:
        options |= {"multiLine": "true", "lineSep": "\n"}
    widths = sorted({width for _, width in layouts})
    for width in widths:
        ddl = ", ".join(f"`{c}` string" for c in S.CORE_COLUMNS[:width])
        parsed = F.lit(None).cast(f"struct<{ddl.replace(' string', ': string')}>")
        for delimiter, of_width in layouts:
            if of_width == width:
                row = F.from_csv("LINE", ddl, {"sep": delimiter, **options})
                parsed = row if len(layouts) == 1 else F.when(
                    (F.col("DELIMITER") == delimiter) & (F.col("WIDTH") == width), row
                ).otherwise(parsed)
        lines = lines.withColumn(f"_ROW{width}", parsed)
    # A generator keeps later filters from parsing the lines once more.
    lines = stage_barrier(lines.select("FILE", "FOLDER", *[f"_ROW{width}" for width in widths]))

    def value(column: str) -> Column:
        found = [F.col(f"_ROW{width}")[column] for width in widths
                 if column in S.CORE_COLUMNS[:width]]
        return (F.coalesce(*found) if found else F.lit(None).cast("string")).alias(column)

    return lines.select(*[value(c) for c in S.CORE_COLUMNS], "FILE", "FOLDER")


def read_core(
    spark: SparkSession,
    root: str,
    layout: CsvLayout | None = None,
    always_clean: bool = False,
    fail_fast: bool = False,
    quoted_newlines: bool = False,
) -> DataFrame:
    """All policy rows under ``root``/folder/file.csv, as strings.

    Without ``layout``, the first line of each file is read before, for its layout. All files
    are read by one scan, whatever their layouts. ``always_clean`` repairs the
    quoting of every line. ``quoted_newlines`` says that quoted fields may hold line
    breaks; their files are split like others.
    """
    if layout is not None:
        hidden = source_files(spark, root, (".csv",)).where(F.col("KIND") == HIDDEN)
        _report(hidden.select("PATH"), "CSV files start with _ or a dot, rename them:")
        return read_layout(spark, [core_pattern(root)], layout, fail_fast)
    files = core_files(spark, root).cache()
    layouts = require_core_files(files, root)
    lines = _lines(spark, [core_pattern(root)], quoted_newlines)
    if len(layouts) == 1:
        delimiter, width = layouts[0]
    else:
        delimiter, width = F.col("DELIMITER"), F.col("WIDTH")
        of_file = files.where(F.col("KIND") == READ).select("FOLDER", "FILE", "DELIMITER", "WIDTH")
        if of_file.count() <= _BROADCAST_FILES:
            of_file = F.broadcast(of_file)
        lines = lines.join(of_file, ["FOLDER", "FILE"])
    if not quoted_newlines:
        lines = clean_lines(lines, delimiter, width, always_clean)
    return _parse_layouts(lines, layouts, fail_fast, quoted_newlines)
