"""Source files for the file-reading queries, written by Spark from the given tables."""

from __future__ import annotations

import io
import itertools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pa_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth import schemas as S


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder the session names.

    Only a session on one machine that names none, as in tests, gets a local
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/covermonth-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="covermonth-")


def write_deliveries(df: DataFrame, root: str, name: str, number: int) -> None:
    """CSV files of one name in as many subfolders, each written by a task of its own."""
    spark, made = df.sparkSession, f"{root}/made"
    write_csv(df.coalesce(number), made)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [s.getPath() for s in system.listStatus(path(made))
             if s.getPath().getName().startswith("part-")]
    for i, file in enumerate(files):
        system.mkdirs(path(f"{root}/delivery {i}"))
        system.rename(file, path(f"{root}/delivery {i}/{name}"))
    system.delete(path(made), True)


def write_csv(df: DataFrame, folder: str, **options) -> None:
    """CSV files with a header; blanks around values are kept."""
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
               "escape": '"', **options}
    df.write.mode("append").options(header=True, **options).csv(folder)


def write_lines(df: DataFrame, line: Column, header: str, folder: str) -> None:
    """Files of raw lines, the first of each being ``header``."""
    lines = df.select(line.alias(header))
    write_csv(lines, folder, sep="\x01", quote="", escape="\x02")


def in_parts(df: DataFrame, number: int) -> list[DataFrame]:
    """The whole of ``df`` as ``number`` frames, by ID."""
    part = F.col("ID").cast("bigint") % number
    return [df.where(part == i) for i in range(number)]


def write_core_folders(
    df: DataFrame | list[DataFrame], root: str, options: list[dict]
) -> None:
    """Policy rows spread over one folder per set of CSV options.

    A frame is cut into parts, and all its rows are made for each of them; parts that are made
    on their own can be given as a list.
    """
    parts = df if isinstance(df, list) else in_parts(df, len(options))
    for i, part in enumerate(parts):
        write_csv(part, f"{root}/carpeta {i}", **options[i])


# --- workbooks -----------------------------------------------------------

ROWS_PER_WORKBOOK = 25_000
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _row_xml(values: list[str | None]) -> str:
    cells = "".join(
        f'<c r="{chr(65 + i)}1" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
        for i, v in enumerate(values) if v is not None
    )
    return f"<row>{cells}</row>"


def _write_bytes(path: str, content: bytes) -> None:
    """Write a file from a task, on the file system of its path."""
    system, name = pa_fs.FileSystem.from_uri(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    with system.open_output_stream(name) as stream:
        stream.write(content)


def _write_book(path: str, sheets: dict[str, Iterator[bytes | pa.Buffer]]) -> None:
    """A minimal workbook; the rows of its sheets are given as XML."""
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        names = list(sheets)
        entries = "".join(
            f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        links = "".join(
            f'<Relationship Id="rId{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(names) + 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}">'
                                         f"<sheets>{entries}</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels",
                      f'<Relationships xmlns="{_PACKAGE}">{links}</Relationships>')
        for i, name in enumerate(names, 1):
            with book.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as sheet:
                sheet.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                for rows in sheets[name]:
                    sheet.write(rows)
                sheet.write(b"</sheetData></worksheet>")
    _write_bytes(path, content.getvalue())


def write_workbook(path: str, sheets: dict[str, Iterator[list[str | None]]]) -> None:
    """A minimal workbook with text cells."""
    def rows(sheet: Iterator[list[str | None]]) -> Iterator[bytes]:
        return (_row_xml(values).encode() for values in sheet)

    _write_book(path, {name: rows(sheet) for name, sheet in sheets.items()})


def _rows_xml(columns: list[pa.Array | pa.Scalar]) -> pa.StringArray:
    """What _row_xml makes of each row."""
    def cell(place: int, value: pa.Array | pa.Scalar) -> pa.Array | pa.Scalar:
        for character, reference in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;")):
            value = pc.replace_substring(value, character, reference)
        found = pc.binary_join_element_wise(
            f'<c r="{chr(65 + place)}1" t="inlineStr"><is><t xml:space="preserve">', value,
            "</t></is></c>", "")
        return pc.fill_null(found, "")

    cells = [cell(i, value) for i, value in enumerate(columns)]
    return pc.binary_join_element_wise("<row>", *cells, "</row>", "")


def _texts_end_to_end(texts: pa.StringArray) -> pa.Buffer:
    """The bytes of all texts of a column, one after the other, as Arrow holds them."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    return data.slice(int(ends[0]), int(ends[-1] - ends[0]))


def _write_books(
    df: DataFrame, columns: list[str], path_of: Callable[[int], str],
    more_sheets: Callable[[], tuple[dict, dict]], note: str | None = None,
) -> None:
    """A workbook from each partition with rows, ROWS_PER_WORKBOOK of them on average.

    The claims are made once: they are counted from a written table, and each written file is
    dealt to all workbooks in turn. Workbooks are named after partitions, so a repeated task leaves
    no second one. With ``note`` there is a column of it before the others, in all rows but the first.
    """
    staged = f"{scratch_folder(df.sparkSession)}/claims"
    df.select(*S.CLAIMS_COLUMNS).write.parquet(staged)
    claims = df.sparkSession.read.parquet(staged)
    workbooks = claims.count() // ROWS_PER_WORKBOOK + 1
    header = columns if note is None else ["NOTA", *columns]

    def write_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (batch for batch in batches if batch.num_rows)
        first = next(filled, None)
        if first is None:
            return

        def xml(batch: pa.RecordBatch, text: str | None) -> pa.Buffer:
            before = [] if note is None else [pa.scalar(text, pa.string())]
            return _texts_end_to_end(_rows_xml([*before, *(batch[c] for c in columns)]))

        def sheet() -> Iterator[bytes | pa.Buffer]:
            yield _row_xml(header).encode()
            yield xml(first.slice(0, 1), None)
            for batch in itertools.chain([first.slice(1)], filled):
                if batch.num_rows:
                    yield xml(batch, note)

        before, after = more_sheets()
        _write_book(path_of(TaskContext.get().partitionId()),
                    {**before, "Siniestros": sheet(), **after})
        yield pa.RecordBatch.from_pydict({"books": pa.array([1], pa.int64())})

    turn = (F.col("_metadata.row_index") % workbooks).cast("int")
    rows = claims.repartitionById(workbooks, turn)
    rows.mapInArrow(write_partition, "books long").agg(F.sum("books")).collect()


def write_claims_workbooks(df: DataFrame, folder: str) -> None:
    """Workbooks with a sheet of claims, a sheet of notes and an empty sheet."""
    def more_sheets() -> tuple[dict, dict]:
        notes = [_row_xml(values).encode() for values in (["RAMO", "TEXTO"], ["1", "x"])]
        return {"Notas": iter(notes)}, {"Vacia": iter([])}

    # Column order and surplus columns must not matter.
    _write_books(df, S.CLAIMS_COLUMNS[::-1], lambda i: f"{folder}/{i:06}.xlsx", more_sheets, "x")


def write_named_workbooks(df: DataFrame, folder: str, name: str) -> None:
    """Workbooks of one name with one sheet of claims, each in a subfolder of its own.

    A sheet cannot hold more than a million rows, so their number follows from the rows.
    """
    _write_books(df, S.CLAIMS_COLUMNS, lambda i: f"{folder}/{i:06}/{name}", lambda: ({}, {}))
