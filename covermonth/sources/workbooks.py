"""Claims workbooks: every sheet of every .xlsx file in a folder.

Spark lists and distributes the workbooks; a task reads one workbook at a
time, block by block, with the standard library. Sheets that lack the expected
columns come out as rows with ERROR set, so that nothing is skipped unseen.
"""

from __future__ import annotations

import datetime
import functools
import io
import itertools
import logging
import re
import zipfile
from collections.abc import Callable, Iterator
from typing import NamedTuple
from xml.etree import ElementTree
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.sources.inventory import EMPTY, HIDDEN, MARK, OTHER, source_files

log = logging.getLogger(__name__)

# Reason given for a workbook that could be read, but has no row of claims.
NO_CLAIMS = "no claims"
_BATCH_ROWS = 10_000
_MOST_ROWS = 1 << 20  # of a sheet, fixed by the workbook standard
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_VALUE, _INLINE, _TEXT, _RUN = f"{_MAIN}v", f"{_MAIN}is", f"{_MAIN}t", f"{_MAIN}r"
_ROW, _SHEET_DATA = f"{_MAIN}row", f"{_MAIN}sheetData"
# Plain sheets, as programs write them: what stands before their rows, and cells with a value, an
# unformatted text or nothing.
_BLOCK = 1 << 22
_ROW_END = b"</row>"
_PLAIN_HEAD = re.compile(
    rb'\s*(?:<\?xml version="1\.0"(?: encoding="[Uu][Tt][Ff]-8")?(?: standalone="\w+")?\s*\?>)?\s*'
    rb'<worksheet(?=[^<>]*\sxmlns="' + re.escape(_MAIN[1:-1].encode()) + rb'")[^<>]*>(?:(?!<[!?]|<row[ >]|xmlns).)*<sheetData>\s*',
    re.DOTALL)
# Tags of plain sheets, and which may stand next to which; texts count after <v> and <t> only.
(_IN_ROW, _OUT_ROW, _IN_CELL, _NO_VALUE, _OUT_CELL, _IN_V, _OUT_V, _IN_IS, _OUT_IS, _IN_T,
 _OUT_T) = range(11)
_PLAIN_TAGS = {"<row>": _IN_ROW, "</row>": _OUT_ROW, "</c>": _OUT_CELL, "<v>": _IN_V, "</v>": _OUT_V,
               "<is>": _IN_IS, "</is>": _OUT_IS, "<t>": _IN_T, '<t xml:space="preserve">': _IN_T,
               "</t>": _OUT_T}
_NEXT_TAGS = np.zeros((11, 11), bool)
for _tag, _next in {
        _IN_ROW: (_IN_CELL, _NO_VALUE, _OUT_ROW), _OUT_ROW: (_IN_ROW,), _IN_CELL: (_IN_V, _IN_IS),
        _NO_VALUE: (_IN_CELL, _NO_VALUE, _OUT_ROW), _OUT_CELL: (_IN_CELL, _NO_VALUE, _OUT_ROW),
        _IN_V: (_OUT_V,), _OUT_V: (_OUT_CELL,), _IN_IS: (_IN_T,), _IN_T: (_OUT_T,),
        _OUT_T: (_OUT_IS,), _OUT_IS: (_OUT_CELL,)}.items():
    _NEXT_TAGS[_tag, list(_next)] = True
# Row numbers are left out, so that a sheet has few different tags.
_NUMBERED = r'^<(c|row) r="([A-Z]*)[0-9]+"'
_PLAIN_ROW = re.compile(r"<row [^<>]*[^<>/]>")
_PLAIN_CELL = re.compile(r'<c r="([A-Z]+)"([^<>]*)>')
_PLAIN_ATTRIBUTES = re.compile(r'(?: s="([0-9]+)")?(?: t="([a-zA-Z]+)")?(/?)')
_REFERENCE = re.compile("&(#x[0-9a-fA-F]+|#[0-9]+|[a-z]+);")
_NAMED = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}
# Number formats of the workbook standard that show dates.
_DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_CONVERTED = {"n", "s", "b", "e"}  # types of which the text of a cell is not the value
_LISTED_FILES = 20
_OUTPUT_COLUMNS = [*S.CLAIMS_COLUMNS, "FILE", "SHEET", "ERROR"]


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


class _NotPlain(Exception):
    """A sheet has more than plain rows and cells."""


class _Tags(dict):
    """Kind, column, type and style of tags without row numbers."""

    def __missing__(self, tag: str) -> tuple[int, int, tuple[str, str | None] | None]:
        kind = _PLAIN_TAGS.get(tag)
        if _PLAIN_ROW.fullmatch(tag):
            kind = _IN_ROW
            _require_element(f"{tag}</row>".encode())
        if kind is not None:
            found = self[tag] = (kind, -1, None)
            return found
        cell = _PLAIN_CELL.fullmatch(tag)
        attributes = cell and _PLAIN_ATTRIBUTES.fullmatch(cell[2])
        if not attributes:
            raise _NotPlain
        found = self[tag] = (_NO_VALUE if attributes[3] else _IN_CELL, _column_number(cell[1]),
                             (attributes[2] or "n", attributes[1]))
        return found


class _Cells(NamedTuple):
    """Cells of some rows in their order: row, column and text of each."""

    number: int  # of rows
    row: np.ndarray
    column: np.ndarray
    text: pa.StringArray

    def first_row(self) -> dict[int, str | None]:
        end = int(np.searchsorted(self.row, 1))
        return dict(zip(self.column[:end].tolist(), self.text[:end].to_pylist(), strict=True))

    def rows(self) -> list[dict[int, str | None]]:
        rows: list[dict[int, str | None]] = [{} for _ in range(self.number)]
        for row, column, text in zip(
                self.row.tolist(), self.column.tolist(), self.text.to_pylist(), strict=True):
            rows[row][column] = text
        return rows

    def texts_of(self, column: int, first: int) -> pa.StringArray:
        """Texts of a column from the row ``first`` on, the last one if a row has several."""
        here = np.flatnonzero(self.column == column)
        place = np.full(self.number, -1)
        place[self.row[here]] = here
        place = place[first:]
        return self.text.take(pa.array(place, mask=place < 0))


def _require_xml(parser: expat.XMLParserType, text: bytes, is_end: bool) -> None:
    """Let the parser go on; what it refuses is not plain."""
    try:
        parser.Parse(text, is_end)
    except expat.ExpatError:
        raise _NotPlain from None


def _require_element(content: bytes) -> None:
    _require_xml(expat.ParserCreate(), b"<x>" + content + b"</x>", True)


def _require_characters(block: bytes, data: np.ndarray) -> None:
    """Only what XML allows outside of tags and references, else _NotPlain."""
    controls = np.count_nonzero(data < ord(" "))
    if controls and controls != block.count(b"\n") + block.count(b"\t") or any(text in block for text in (b"]]>", b"\xef\xbf\xbe", b"\xef\xbf\xbf")):
        raise _NotPlain
    try:
        block.decode()
    except UnicodeDecodeError:
        raise _NotPlain from None


def _changed(
    texts: pa.StringArray, chosen: np.ndarray, change: Callable[[str], str | None]
) -> pa.StringArray:
    """Texts with the chosen ones changed, each different one once."""
    found = texts.filter(pa.array(chosen)).dictionary_encode()
    changed = pa.array([change(text) for text in found.dictionary.to_pylist()], pa.string())
    return pc.replace_with_mask(texts, pa.array(chosen), changed.take(found.indices))


def _character(reference: re.Match) -> str:
    name = reference[1]
    if name[0] != "#":
        return _NAMED[name]
    return chr(int(name[2:], 16) if name[1] == "x" else int(name[1:]))


def _decoded(text: str) -> str:
    """Text of a plain value, without character references."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _text(element: ElementTree.Element) -> str:
    """All text runs below an element, without phonetic hints."""
    runs = []
    for part in element:
        if part.tag == _TEXT:
            runs.append(part.text or "")
        elif part.tag == _RUN:
            runs.append(part.findtext(_TEXT) or "")
    return "".join(runs)


class _Workbook:
    """Sheets of one workbook as rows of strings."""

    def __init__(self, content: bytes):
        self._zip = zipfile.ZipFile(io.BytesIO(content))
        book = self._xml("xl/workbook.xml")
        links = {r.get("Id"): r.get("Target") for r in self._xml("xl/_rels/workbook.xml.rels")}
        self.sheets = {
            s.get("name"): self._part(links[s.get(_RELATION)])
            for s in book.iter(f"{_MAIN}sheet")
        }
        properties = book.find(f"{_MAIN}workbookPr")
        is_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        self._epoch = datetime.datetime(1904, 1, 1) if is_1904 else datetime.datetime(1899, 12, 30)
        self._tags = _Tags()
        self._strings = self._shared_strings()
        self._date_styles = self._styles_showing_dates()

    @staticmethod
    def _part(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def _xml(self, name: str) -> ElementTree.Element:
        with self._zip.open(name) as part:
            return ElementTree.parse(part).getroot()

    def _shared_strings(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self._zip.namelist():
            return []
        return [_text(item) for item in self._xml("xl/sharedStrings.xml")]

    def _styles_showing_dates(self) -> set[int]:
        if "xl/styles.xml" not in self._zip.namelist():
            return set()
        styles = self._xml("xl/styles.xml")
        date_ids = set(_DATE_FORMAT_IDS)
        for form in styles.iter(f"{_MAIN}numFmt"):
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", form.get("formatCode", ""))
            if re.search("[dmyh]", code, re.IGNORECASE):
                date_ids.add(int(form.get("numFmtId")))
        cells = styles.find(f"{_MAIN}cellXfs")
        formats = [] if cells is None else [int(x.get("numFmtId", 0)) for x in cells]
        return {i for i, form in enumerate(formats) if form in date_ids}

    def _value(self, kind: str, style: str | None, value: str) -> str | None:
        """Text of a cell with a value of the given type."""
        if kind == "s":
            return self._strings[int(value)]
        if kind == "b":
            return "true" if value == "1" else "false"
        if kind == "e":
            return None
        if kind != "n":
            return value
        number = float(value)
        if style is not None and int(style) in self._date_styles:
            moment = self._epoch + datetime.timedelta(days=number, milliseconds=500)
            return moment.strftime("%Y-%m-%d %H:%M:%S")
        return str(int(number)) if number.is_integer() else value

    def _cell(self, cell: ElementTree.Element) -> str | None:
        for part in cell:
            if part.tag == _VALUE and part.text is not None:
                return self._value(cell.get("t", "n"), cell.get("s"), part.text)
            if part.tag == _INLINE:
                return _text(part)
        return None

    def rows(self, part: str) -> Iterator[dict[int, str | None]]:
        done = 0
        try:
            for row in self._plain_rows(part):
                yield row
                done += 1
        except _NotPlain:
            yield from itertools.islice(self._all_rows(part), done, None)

    def _plain_rows(self, part: str) -> Iterator[dict[int, str | None]]:
        for cells in self.plain_cells(part):
            yield from cells.rows()

    def plain_cells(self, part: str) -> Iterator[_Cells]:
        """Cells of a sheet that holds plain ones only, else _NotPlain at the first block that does not.

        The XML parser sees what stands around the rows, without a call for each element; blocks of
        rows are well-formed if all their tags and texts are plain. What is not goes to ``_all_rows``.
        """
        check = expat.ParserCreate()
        held, in_data = b"", False
        with self._zip.open(part) as stream:
            while block := stream.read(_BLOCK):
                held += block
                end = held.rfind(_ROW_END) + len(_ROW_END)
                if end < len(_ROW_END):
                    if not in_data:
                        raise _NotPlain
                    continue
                rows, held = held[:end], held[end:]
                if not in_data:
                    head = _PLAIN_HEAD.match(rows)
                    if head is None:
                        raise _NotPlain
                    _require_xml(check, rows[:head.end()], False)
                    rows, in_data = rows[head.end():], True
                yield self._block_cells(rows)
        if not in_data or not held.lstrip().startswith(b"</sheetData>") or (
                re.search(rb"<(?:\w+:)?row[ >/]", held)):
            raise _NotPlain
        _require_xml(check, held, True)

    def _block_cells(self, block: bytes) -> _Cells:
        """The cells of a text that ends with a row."""
        if b"xmlns" in block:
            raise _NotPlain
        if b"\r" in block:
            block = block.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
        data = np.frombuffer(block, np.uint8)
        _require_characters(block, data)
        starts, closes = np.flatnonzero(data == ord("<")), np.flatnonzero(data == ord(">"))
        if len(closes) != len(starts):  # texts may hold >
            closes = closes[np.searchsorted(closes, starts)]
        ends = closes + 1
        if block[:starts[0]].strip() or (closes < starts).any() or (closes[:-1] > starts[1:]).any():
            raise _NotPlain
        # Tag and following text by turns, as Arrow holds them.
        offsets = np.full(2 * len(starts) + 1, len(block), np.int32)
        offsets[:-1:2], offsets[1::2] = starts, ends
        parts = pa.StringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(block))
        tags = parts.take(pa.array(np.arange(0, len(parts), 2))).dictionary_encode()
        plain = pc.replace_substring_regex(
            tags.dictionary, _NUMBERED, r'<\1 r="\2"').dictionary_encode()
        known = [self._tags[tag] for tag in plain.dictionary.to_pylist()]
        which = plain.indices.to_numpy()[tags.indices.to_numpy()]
        kind = np.array([k for k, _, _ in known], np.int8)[which]
        if kind[0] != _IN_ROW or kind[-1] != _OUT_ROW or not _NEXT_TAGS[kind[:-1], kind[1:]].all():
            raise _NotPlain

        cell = np.flatnonzero((kind == _IN_CELL) | (kind == _NO_VALUE))
        which, empty, typed = which[cell], kind[cell] == _NO_VALUE, kind[cell + 1] == _IN_V
        place = 2 * np.where(typed, cell + 1, cell + 2) + 1
        place[empty] = 0
        if (offsets[place + 1] == offsets[place]).any():
            raise _NotPlain
        texts = parts.take(pa.array(place, mask=empty))
        if marks := block.count(b"&"):
            found = pc.fill_null(pc.count_substring(texts, "&"), 0).to_numpy()
            if found.sum() != marks:
                raise _NotPlain
            _require_element(" ".join(texts.filter(pa.array(found > 0)).unique().to_pylist()).encode())
            texts = _changed(texts, found > 0, _decoded)
        for number in np.unique(which[typed]):
            kind_of, style = known[number][2]
            if kind_of in _CONVERTED:
                texts = _changed(texts, typed & (which == number),
                                 functools.partial(self._value, kind_of, style))
        row = np.cumsum(kind == _IN_ROW) - 1
        return _Cells(int(row[-1]) + 1, row[cell], np.array([c for _, c, _ in known])[which], texts)

    def _all_rows(self, part: str) -> Iterator[dict[int, str | None]]:
        """Rows of any sheet, element by element."""
        with self._zip.open(part) as stream:
            data = None
            for event, element in ElementTree.iterparse(stream, events=("start", "end")):
                if event == "start":
                    data = element if element.tag == _SHEET_DATA else data
                elif element.tag == _ROW:
                    row = {}
                    for position, cell in enumerate(element):
                        reference = cell.get("r")
                        index = _column_number(reference) if reference else position
                        row[index] = self._cell(cell)
                    data.clear()
                    yield row


def _claims_columns(header: dict[int, str | None]) -> list[int]:
    """Where a sheet has the claims columns, by the names in its first row."""
    places = {name: index for index, name in header.items()}
    missing = [name for name in S.CLAIMS_COLUMNS if name not in places]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return [places[name] for name in S.CLAIMS_COLUMNS]


def _sheet_columns(book: _Workbook, part: str) -> Iterator[list[pa.StringArray]]:
    """The claims columns of a sheet, some rows at a time."""
    indexes, done = None, 0
    try:
        for cells in book.plain_cells(part):
            first = 0
            if indexes is None:
                indexes, first = _claims_columns(cells.first_row()), 1
            yield [cells.texts_of(index, first) for index in indexes]
            done += cells.number
        return
    except _NotPlain:
        rows = itertools.islice(book._all_rows(part), done, None)
    if indexes is None:
        indexes = _claims_columns(next(rows, {}))
    while some := list(itertools.islice(rows, _BATCH_ROWS)):
        yield [pa.array([row.get(index) for row in some], pa.string()) for index in indexes]


def _error(name: str, sheet: str | None, reason: str) -> pa.RecordBatch:
    return _to_batch([pa.nulls(1, pa.string())] * len(S.CLAIMS_COLUMNS), name, sheet, reason)


def _sheet_batches(book: _Workbook, part: str, name: str, sheet: str) -> list[pa.RecordBatch]:
    """All rows of a sheet. They are held until its end, as a broken sheet is skipped as a
    whole; the format allows no more than a million."""
    batches, count = [], 0
    for columns in _sheet_columns(book, part):
        count += len(columns[0])
        if count > _MOST_ROWS:
            raise ValueError("more rows than the format allows")
        if len(columns[0]):
            batches.append(_to_batch(columns, name, sheet))
    return batches


def _workbook_batches(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
    name = path.rsplit("/", 1)[-1]
    if not name.lower().endswith(".xlsx"):
        yield _error(name, None, "format not supported, save as .xlsx")
        return
    try:
        book = _Workbook(content)
    except Exception as error:
        yield _error(name, None, f"workbook not readable: {error}")
        return
    has_claims = False
    for sheet, part in book.sheets.items():
        try:
            batches = _sheet_batches(book, part, name, sheet)
        except Exception as error:
            yield _error(name, sheet, f"sheet not readable: {error}")
            continue
        has_claims = has_claims or bool(batches)
        yield from batches
    if not has_claims:
        yield _error(name, None, NO_CLAIMS)


def _to_batch(
    columns: list[pa.StringArray], name: str, sheet: str | None, error: str | None = None
) -> pa.RecordBatch:
    more = [pa.repeat(pa.scalar(text, pa.string()), len(columns[0])) for text in (name, sheet, error)]
    return pa.RecordBatch.from_arrays([*columns, *more], _OUTPUT_COLUMNS)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            yield from _workbook_batches(path.as_py(), content.as_py())


def workbook_files(spark: SparkSession, folder: str, depth: int = 0) -> DataFrame:
    """Inventory of a folder of workbooks, or of its subfolders with ``depth`` 1."""
    return source_files(spark, folder, (".xlsx", ".xls"), depth)


def require_workbooks(files: DataFrame, folder: str) -> None:
    """Fail if there are no workbooks, or some that cannot be read as they are."""
    counts = {row.KIND: row["count"] for row in files.groupBy("KIND").count().collect()}
    if not set(counts) - {OTHER, MARK}:
        raise FileNotFoundError(f"no workbooks in {folder}")
    for kind, message in ((EMPTY, "empty workbooks"),
                          (HIDDEN, "workbooks start with _ or a dot, rename them")):
        if kind in counts:
            names = files.where(F.col("KIND") == kind).select("PATH").limit(_LISTED_FILES).collect()
            raise ValueError(f"{counts[kind]} {message}: {[row.PATH for row in names]}")
    if OTHER in counts:
        log.warning("%d other files in %s, skipped", counts[OTHER], folder)


def read_workbooks(spark: SparkSession, folder: str, depth: int = 0) -> DataFrame:
    """Claims rows of all workbooks in ``folder``, and rows for skipped sheets.

    With ``depth`` 1, workbooks lie in subfolders of it, one per delivery.
    Columns: the six claims columns, FILE, SHEET and ERROR. ERROR is NULL for
    claims rows. A workbook without any claim has a row of its own. A sheet
    that breaks off is skipped as a whole. A file without a single byte is an error, as is a
    workbook whose name starts with _ or a dot, which Spark would not see.
    """
    require_workbooks(workbook_files(spark, folder, depth), folder)
    books = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{[xX][lL][sS][xX],[xX][lL][sS]}")
        .load(f"{folder.rstrip('/')}/*" if depth else folder)
        .select("path", "content")
    )
    schema = ", ".join(f"`{c}` string" for c in _OUTPUT_COLUMNS)
    return books.mapInArrow(_read_batches, schema)


def claims_rows(workbook_rows: DataFrame) -> DataFrame:
    """The claims among the workbook rows, with FILE."""
    return workbook_rows.where(F.col("ERROR").isNull()).select(*S.CLAIMS_COLUMNS, "FILE")


def skipped_sheets(workbook_rows: DataFrame) -> DataFrame:
    """Sheets and workbooks that were not read, and why."""
    return workbook_rows.where(F.col("ERROR").isNotNull()).select("FILE", "SHEET", "ERROR")


def _without_claims(workbook_rows: DataFrame, *more: Column) -> DataFrame:
    """Files that gave no claim. Counts alone are hashed: ``more`` of texts sorts all rows."""
    claims = F.count_if(F.col("ERROR").isNull()).alias("claims")
    return workbook_rows.groupBy("FILE").agg(claims, *more).where("claims = 0")


def require_claims(workbook_rows: DataFrame) -> None:
    """Report skipped sheets; fail if a workbook gave no claim at all."""
    for row in skipped_sheets(workbook_rows).toLocalIterator():
        log.warning("skipped sheet %s of %s: %s", row.SHEET, row.FILE, row.ERROR)
    if _without_claims(workbook_rows).isEmpty():
        return
    empty = _without_claims(workbook_rows, F.max("ERROR").alias("error")).select("FILE", "error")
    listed = empty.limit(_LISTED_FILES).collect()
    if listed:
        raise ValueError(f"{empty.count()} workbooks without claims:\n" + "\n".join(
            f"{row.FILE} | {row.error}" for row in listed))
