"""File-shaped tests of the claims workbook source."""

from __future__ import annotations

import logging
import subprocess
import sys
import zipfile
from pathlib import Path
from xml.etree import ElementTree

import pytest

from covermonth import schemas as S
from covermonth.plans.layers import BRONZE, CLAIMS, Paths, ingest_claims, load_claims, run_direct
from covermonth.sinks.tables import layer_exists
from covermonth.sources import workbooks
from covermonth.sources.workbooks import claims_rows, read_workbooks, skipped_sheets
from verification import files
from verification.files import write_workbook
from verification.queries import QUERIES
from conftest import SF_DIR

CLAIM = ["12345678", "1", "P1", "C1", "ANA", "2020-01-31"]


def test_sheets_and_skipped_sheets(spark, tmp_path):
    write_workbook(f"{tmp_path}/uno.xlsx", {
        "Ok": iter([[*reversed(S.CLAIMS_COLUMNS), "EXTRA"], [*reversed(CLAIM), "x"]]),
        "Sin columnas": iter([["DNI", "RAMO"], ["1", "2"]]),
        "Vacia": iter([]),
        "Otra": iter([S.CLAIMS_COLUMNS, [None, *CLAIM[1:]], CLAIM]),
    })
    (tmp_path / "viejo.xls").write_bytes(b"\xd0\xcf")
    (tmp_path / "roto.xlsx").write_bytes(b"no zip")
    (tmp_path / "nota.txt").write_text("x")
    rows = read_workbooks(spark, str(tmp_path))
    found = sorted(tuple(r) for r in claims_rows(rows).fillna("").collect())
    assert found == sorted([(*CLAIM, "uno.xlsx"), (*CLAIM, "uno.xlsx"),
                            ("", *CLAIM[1:], "uno.xlsx")])
    skipped = {(r.FILE, r.SHEET): r.ERROR for r in skipped_sheets(rows).collect()}
    assert set(skipped) == {("uno.xlsx", "Sin columnas"), ("uno.xlsx", "Vacia"),
                            ("viejo.xls", None), ("roto.xlsx", None)}
    assert "columns not found" in skipped["uno.xlsx", "Sin columnas"]
    assert "not supported" in skipped["viejo.xls", None]


def test_cell_types(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    write_workbook(f"{tmp_path}/uno.xlsx", {"Ok": iter([S.CLAIMS_COLUMNS])})
    with zipfile.ZipFile(tmp_path / "uno.xlsx") as book:
        parts = {n: book.read(n).decode() for n in book.namelist()}
    parts["xl/sharedStrings.xml"] = (
        f"<sst {main}><si><t>uno</t></si><si><r><t>do</t></r><r><t>s</t></r></si></sst>")
    parts["xl/styles.xml"] = (
        f'<styleSheet {main}><numFmts><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/>'
        '<numFmt numFmtId="165" formatCode="0.0&quot;d&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/>'
        '<xf numFmtId="165"/></cellXfs></styleSheet>')
    cells = ('<row r="2"><c r="A2"><v>12345678</v></c><c r="B2" t="s"><v>1</v></c>'
             '<c r="C2" t="b"><v>1</v></c><c r="D2" s="3"><v>1.5</v></c>'
             '<c r="F2" s="2"><v>43861.5</v></c></row>'
             '<row r="3"><c r="A3" t="str"><v>7</v></c><c r="E3" t="e"><v>#N/A</v></c>'
             '<c r="F3" s="1"><v>43861</v></c></row>')
    sheet = "xl/worksheets/sheet1.xml"
    parts[sheet] = parts[sheet].replace("</sheetData>", cells + "</sheetData>")
    with zipfile.ZipFile(tmp_path / "uno.xlsx", "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    rows = claims_rows(read_workbooks(spark, str(tmp_path))).drop("FILE").collect()
    assert [tuple(r) for r in rows] == [
        ("12345678", "dos", "true", "1.5", None, "2020-01-31 12:00:00"),
        ("7", None, None, None, None, "2020-01-31 00:00:00"),
    ]


def test_ingestion_reports_skipped_sheets(spark, tmp_path, caplog):
    source = tmp_path / "source"
    source.mkdir()
    write_workbook(f"{source}/uno.xlsx", {
        "Ok": iter([S.CLAIMS_COLUMNS, CLAIM]), "Vacia": iter([])})
    with caplog.at_level(logging.WARNING):
        assert ingest_claims(spark, str(source), str(tmp_path / "lake")) == 1
    assert "Vacia" in caplog.text
    table = load_claims(spark, str(tmp_path / "lake"))
    assert table.columns == [*S.CLAIMS_COLUMNS, "FILE", "FECHA_CARGA"]


def test_no_workbooks_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no workbooks"):
        read_workbooks(spark, str(tmp_path))


def test_workbook_without_a_byte_is_an_error(spark, tmp_path):
    write_workbook(f"{tmp_path}/uno.xlsx", {"Ok": iter([S.CLAIMS_COLUMNS, CLAIM])})
    (tmp_path / "nada.xlsx").write_bytes(b"")
    with pytest.raises(ValueError, match="empty workbooks.*nada"):
        read_workbooks(spark, str(tmp_path))


def test_workbook_without_claims_is_an_error(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    write_workbook(f"{source}/uno.xlsx", {"Ok": iter([S.CLAIMS_COLUMNS, CLAIM])})
    write_workbook(f"{source}/dos.xlsx", {"Ok": iter([S.CLAIMS_COLUMNS])})
    write_workbook(f"{source}/tres.xlsx", {"Vacia": iter([])})
    with pytest.raises(ValueError, match="(?s)2 workbooks without claims.*dos.xlsx.*tres.xlsx"):
        ingest_claims(spark, str(source), str(tmp_path / "lake"))
    assert not layer_exists(spark, str(tmp_path / "lake"), BRONZE, CLAIMS)
    (source / "viejo.xls").write_bytes(b"x")
    (tmp_path / "out").mkdir()
    with pytest.raises(ValueError, match="(?s)3 workbooks without claims.*viejo.xls"):
        run_direct(spark, Paths(claims=str(source), reports=f"{tmp_path}/out"), ("claims",))
    assert list((tmp_path / "out").iterdir()) == []


def test_broken_sheet_is_skipped_as_a_whole(spark, tmp_path):
    write_workbook(f"{tmp_path}/uno.xlsx", {
        "Ok": iter([S.CLAIMS_COLUMNS, CLAIM]),
        "Rota": iter([S.CLAIMS_COLUMNS, *[CLAIM] * 2000])})
    with zipfile.ZipFile(tmp_path / "uno.xlsx") as book:
        parts = {name: book.read(name) for name in book.namelist()}
    broken = parts["xl/worksheets/sheet2.xml"]
    parts["xl/worksheets/sheet2.xml"] = broken[:len(broken) // 2]
    with zipfile.ZipFile(tmp_path / "uno.xlsx", "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
    rows = read_workbooks(spark, str(tmp_path))
    assert claims_rows(rows).count() == 1
    assert [(r.SHEET, "not readable" in r.ERROR) for r in skipped_sheets(rows).collect()] == [
        ("Rota", True)]


def test_registered_queries_run_from_any_folder(tmp_path):
    """Tasks carry their code: workers need not find the repository."""
    script = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession\n"
        "from __spark_entry__ import queries\n"
        "spark = SparkSession.builder.master('local[2]')"
        ".config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('rows', queries()['xlsx_claims_read'](spark, sys.argv[2]).count())\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", script, str(Path(__file__).resolve().parents[1]), SF_DIR],
        cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 6000" in done.stdout


@pytest.mark.parametrize("name", ["_b.xlsx", ".c.xlsx", "_D.XLSX", ".e.xls"])
def test_hidden_workbooks_are_refused(spark, tmp_path, name):
    write_workbook(f"{tmp_path}/uno.xlsx", {"Ok": iter([S.CLAIMS_COLUMNS, CLAIM])})
    write_workbook(f"{tmp_path}/{name}", {"Ok": iter([S.CLAIMS_COLUMNS, CLAIM])})
    with pytest.raises(ValueError, match=f"1 workbooks start with _ or a dot.*{name}"):
        read_workbooks(spark, str(tmp_path))


def test_suffixes_in_any_case_are_read(spark, tmp_path):
    for name in ("uno.xlsx", "DOS.XLSX", "Tres.Xlsx"):
        write_workbook(f"{tmp_path}/{name}", {"Ok": iter([S.CLAIMS_COLUMNS, CLAIM])})
    (tmp_path / "notas.txt").write_text("x")
    found = claims_rows(read_workbooks(spark, str(tmp_path))).collect()
    assert sorted(r.FILE for r in found) == ["DOS.XLSX", "Tres.Xlsx", "uno.xlsx"]


def test_guarded_workbooks_hold_no_more_rows_than_a_sheet_may(spark, monkeypatch):
    """1200 claims a name, where a sheet may have 500."""
    monkeypatch.setattr(workbooks, "_MOST_ROWS", 500)
    monkeypatch.setattr(files, "ROWS_PER_WORKBOOK", 300)
    found = {r.FILE: (r.VERDICT, r.CLAIMS) for r in QUERIES["workbook_guards"](spark, SF_DIR).collect()}
    claims = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr("l_orderkey % 5 part")
    sizes = {r.part: r["count"] for r in claims.groupBy("part").count().collect()}
    assert found == {"uno.xlsx": ("accepted", sizes[0]), "DOS.XLSX": ("accepted", sizes[1]),
                     "_b.xlsx": ("start with _ or a dot", 0), ".c.xlsx": ("start with _ or a dot", 0),
                     "notas.txt": ("no workbooks", 0)}


_HEAD = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
_CELLS = ('<row r="1"><c r="A1" t="str"><v>a</v></c><c r="AB1" t="inlineStr"><is><t>b</t></is></c>'
          '<c r="C1" s="0"/></row>')


@pytest.mark.parametrize("cell", [
    "a&b", "&nbsp;", "&#0;", "&#xFFFF;", "a]]>b", "a\x01b", "a\x0cb", "\ufffe", "\uffff"])
def test_texts_that_break_a_sheet_are_not_plain(tmp_path, cell):
    """The parser refuses them; so must the reader of plain sheets, which does not call it for rows."""
    path = f"{tmp_path}/uno.xlsx"
    for text, where in ((_CELLS.replace(">a<", f">{cell}<"), "value"), (_CELLS + cell, "between"),
                        (_CELLS.replace("<row ", f'<row s="{cell}" '), "row")):
        if where == "row" and "]]>" in cell:
            continue
        write_workbook(path, {"Ok": iter([])})
        with zipfile.ZipFile(path) as book:
            parts = {name: book.read(name) for name in book.namelist()}
        parts["xl/worksheets/sheet1.xml"] = (
            _HEAD + _CELLS + text + _CELLS + "</sheetData></worksheet>").encode()
        with zipfile.ZipFile(path, "w") as book:
            for name, content in parts.items():
                book.writestr(name, content)
        book = workbooks._Workbook(Path(path).read_bytes())
        (part,) = book.sheets.values()
        with pytest.raises(workbooks._NotPlain):
            list(book.plain_cells(part))
        with pytest.raises(ElementTree.ParseError):
            list(book.rows(part))


def test_cells_of_plain_sheets_are_read_by_columns(tmp_path, monkeypatch):
    """No row of a plain sheet is put together; values are changed once for each different one."""
    monkeypatch.setattr(workbooks, "_BLOCK", 3000)
    path = f"{tmp_path}/uno.xlsx"
    claims = [[f"{i % 40:08}", None if i % 3 else f"{i}&<>", *CLAIM[2:]] for i in range(900)]
    write_workbook(path, {"Ok": iter([S.CLAIMS_COLUMNS, *claims])})
    monkeypatch.setattr(workbooks._Cells, "rows", None)
    batches = list(workbooks._workbook_batches(path, Path(path).read_bytes()))
    found = [list(row.values())[:6] for batch in batches for row in batch.to_pylist()]
    assert found == claims


@pytest.mark.parametrize(("sheet", "plain"), [
    (_HEAD + _CELLS * 3 + "</sheetData></worksheet>", True),
    ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\r\n' + _HEAD + _CELLS
     + "</sheetData><mergeCells/></worksheet>", True),
    (_HEAD + _CELLS.replace(">a<", ">&lt;a&#65;&#x42; &amp;amp; \r\n\u00f1<") + "</sheetData></worksheet>", True),
    (_HEAD + _CELLS + "<row r='2'/>" + _CELLS + "</sheetData></worksheet>", False),
    (_HEAD + _CELLS + _CELLS.replace("<v>", "<f>1</f><v>") + "</sheetData></worksheet>", False),
    (_HEAD + _CELLS + _CELLS.replace("<v>a</v>", "<v><![CDATA[<v>x</v>]]></v>") + "</sheetData></worksheet>", False),
    (_HEAD + _CELLS + _CELLS.replace("<v>a</v>", "<!-- <v>x</v> --><v>b</v>") + "</sheetData></worksheet>", False),
    (_HEAD + _CELLS.replace("<is><t>b</t></is>", "<is><r><t>b</t></r><r><t>c</t></r></is>")
     + "</sheetData></worksheet>", False),
    (_HEAD + _CELLS.replace(' t="str"><v>a</v>', "><v/>") + "</sheetData></worksheet>", False),
    (_HEAD + _CELLS + '<c r="A1"><v>1</v></c>' + _CELLS + "</sheetData></worksheet>", False),
    (_HEAD + "</sheetData></worksheet>", False),
    (_HEAD.replace("xmlns=", "xmlns:m=").replace("<", "<m:") + _CELLS + "</m:sheetData></m:worksheet>", False),
])
def test_plain_sheets_are_read_as_all_others(tmp_path, sheet, plain):
    path = f"{tmp_path}/uno.xlsx"
    write_workbook(path, {"Ok": iter([])})
    with zipfile.ZipFile(path) as book:
        parts = {name: book.read(name) for name in book.namelist()}
    parts["xl/worksheets/sheet1.xml"] = sheet.encode()
    with zipfile.ZipFile(path, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
    book = workbooks._Workbook(Path(path).read_bytes())
    (part,) = book.sheets.values()
    expected = list(book._all_rows(part))
    assert list(book.rows(part)) == expected
    if plain:
        assert list(book._plain_rows(part)) == expected
    else:
        with pytest.raises(workbooks._NotPlain):
            list(book._plain_rows(part))


def test_plain_blocks_that_cut_rows(tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "_BLOCK", 700)
    path = f"{tmp_path}/uno.xlsx"
    rows = [[f"{i}\u00f1<&>", None, "x" * (i % 50 + 1)] for i in range(300)]
    write_workbook(path, {"Ok": iter(rows)})
    book = workbooks._Workbook(Path(path).read_bytes())
    found = list(book._plain_rows("xl/worksheets/sheet1.xml"))
    assert [[row.get(i) for i in range(3)] for row in found] == rows


def test_files_without_claims_are_found_without_a_sort(spark):
    rows = [("a.xlsx", None), ("a.xlsx", "x"), ("b.xlsx", "x"), ("b.xlsx", "y"), (None, "z")]
    df = spark.createDataFrame(rows, "FILE string, ERROR string").selectExpr("*", "'S' SHEET")
    found = workbooks._without_claims(df)
    assert sorted(row.FILE or "" for row in found.collect()) == ["", "b.xlsx"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    with pytest.raises(ValueError, match=r"(?s)2 workbooks without claims:.*b\.xlsx \| y"):
        workbooks.require_claims(df)
