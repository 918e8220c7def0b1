"""File-shaped tests of the policy CSV source."""

from __future__ import annotations

import hashlib
import logging

import pytest

from conftest import SF_DIR
from covermonth import schemas as S
from covermonth.sources.csv_files import (
    CsvLayout,
    audit_csv_files,
    clean_line,
    core_files,
    core_pattern,
    parse_lines,
    raw_lines,
    read_core,
)
from covermonth.sources.inventory import FIRST_BLOCK, unread_files
from covermonth.sources.quoted_records import quoted_records

HEADER = ",".join(S.CORE_COLUMNS)


def line(i, name="ANA", sep=",", width=20):
    return sep.join([str(i), "1", "R", "P", f"POL{i}", "C", "T", "EMPRESA", name,
                     *["x"] * 11][:width])


def write(root, folder, file, text, encoding="utf-8"):
    path = root / folder
    path.mkdir(exist_ok=True)
    (path / file).write_bytes(text.encode(encoding))


def lines_of(*rows, header=HEADER, end="\n"):
    return end.join([header, *rows]) + end


def names(df):
    return {r.ID: r.ASEGURADO for r in df.collect()}


def digests(root):
    return {p: hashlib.sha256(p.read_bytes()).hexdigest() for p in root.rglob("*") if p.is_file()}


def test_each_file_by_its_own_layout(spark, tmp_path):
    write(tmp_path, "a ñ+%[1]", "1.csv", lines_of(line(1), line(2, "PEÑA"), end="\r\n"))
    write(tmp_path, "a ñ+%[1]", "2.csv", lines_of(line(3, "PEÑA"), line(4)), "iso-8859-1")
    for n, sep in enumerate(";\t|"):
        write(tmp_path, "b", f"{n}.csv",
              lines_of(line(10 + n, sep=sep), header=HEADER.replace(",", sep)))
    write(tmp_path, "c", "18.csv", lines_of(line(20, width=18), line(21),
          header=",".join(S.CORE_COLUMNS[:18])))
    write(tmp_path, "c", "quoted.csv", lines_of(line(30, '"ANA MARIA, ""X"""'), line(31)))
    write(tmp_path, "d", "wrapped.csv", lines_of(
        '"' + line(40, '""LUZ, ANA""') + '"', '"' + line(41, 'O"HARA') + '"',
        header=f'"{HEADER}"'))
    before = digests(tmp_path)
    df = read_core(spark, str(tmp_path))
    assert df.columns == [*S.CORE_COLUMNS, "FILE", "FOLDER"]
    assert names(df) == {
        "1": "ANA", "2": "PEÑA", "3": "PEÑA", "4": "ANA", "10": "ANA", "11": "ANA", "12": "ANA",
        "20": "ANA", "21": "ANA", "30": 'ANA MARIA, "X"', "31": "ANA",
        "40": "LUZ, ANA", "41": "O'HARA",
    }
    narrow = {(r.PARENTESCO, r.FI) for r in df.where("FILE = '18.csv'").collect()}
    assert narrow == {(None, None)}
    folders = {(r.FOLDER, r.FILE) for r in df.select("FOLDER", "FILE").distinct().collect()}
    assert ("a ñ+%[1]", "1.csv") in folders
    assert digests(tmp_path) == before


def test_audit(spark, tmp_path):
    write(tmp_path, "a", "1.csv", lines_of(line(1), line(2), ""))
    write(tmp_path, "a", "2.csv", lines_of('"' + line(1) + '"', header=f'"{HEADER}"'))
    write(tmp_path, "b", "3.csv", HEADER)
    write(tmp_path, "b", "4.csv", lines_of(line(1, "é"), header=HEADER.replace("FI", '"F,I"')),
          "iso-8859-1")
    audit = {r.FILE: r for r in audit_csv_files(spark, [core_pattern(str(tmp_path))]).collect()}
    assert audit["1.csv"].HEADER == HEADER
    assert [audit[f"{n}.csv"].LINES for n in (1, 2, 3, 4)] == [3, 2, 1, 2]
    assert [audit[f"{n}.csv"].QUOTED_LINES for n in (1, 2, 3, 4)] == [0, 2, 0, 0]
    assert [audit[f"{n}.csv"].IS_UTF8 for n in (1, 2, 3, 4)] == [True, True, True, False]
    assert {audit[f"{n}.csv"].WIDTH for n in (1, 2, 3, 4)} == {20}


def test_line_breaks_in_fields_are_declared(spark, tmp_path):
    rows = [line(1, '"ANA\nX"'), line(2, '"A ""B\nC"" D"'), line(3, '"\n"')]
    write(tmp_path, "a", "1.csv", lines_of(*rows))
    found = read_core(spark, str(tmp_path), quoted_newlines=True)
    assert sorted(r.ASEGURADO for r in found.collect()) == ["\n", 'A "B\nC" D', "ANA\nX"]
    write(tmp_path, "a", "2.csv", lines_of(line(4, '"ANA'), line(5)))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_core(spark, str(tmp_path), quoted_newlines=True).collect()


def test_stray_quotes_lose_no_line(spark, tmp_path):
    rows = [line(i, '"LUZ' if i % 3 == 0 else "ANA") for i in range(1000)]
    write(tmp_path, "a", "1.csv", lines_of(*rows))
    found = read_core(spark, str(tmp_path))
    assert names(found) == {str(i): "'LUZ" if i % 3 == 0 else "ANA" for i in range(1000)}
    assert {r.FI for r in found.collect()} == {"x"}


def test_quote_all_and_wrapped_lines(spark, tmp_path):
    """Each line by itself, whatever the first ones of its file look like."""
    quoted = ",".join(f'"{c}"' for c in S.CORE_COLUMNS)
    fields = '","'.join(line(1, "A, B", sep="\1").split("\1"))
    write(tmp_path, "a", "quoted_header.csv", lines_of(f'"{fields}"', header=quoted))
    write(tmp_path, "a", "bare_header.csv", lines_of(
        f'"{fields}"'.replace('"1"', '"2"', 1), '"' + line(3) + '"', line(4), header=HEADER))
    found = names(read_core(spark, str(tmp_path)))
    assert found == {"1": "A, B", "2": "A, B", "3": "ANA", "4": "ANA"}


def test_hidden_files_are_refused(spark, tmp_path):
    write(tmp_path, "a", "1.csv", lines_of(line(1)))
    write(tmp_path, "a", "_2.csv", lines_of(line(2)))
    for layout in (None, CsvLayout()):
        with pytest.raises(ValueError, match="(?s)1 CSV files start with _ or a dot.*_2.csv"):
            read_core(spark, str(tmp_path), layout)


def test_audit_of_split_files(spark, tmp_path):
    """First lines are found whatever the number and the packing of splits."""
    for n in range(6):
        rows = [line(i, f"NOMBRE {n}") for i in range(300 + n)]
        write(tmp_path, "a", f"{n}.csv", lines_of(*rows, header=HEADER.replace("FI", f"FI{n}")))
    setting = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "4000")
        audit = audit_csv_files(spark, [core_pattern(str(tmp_path))]).collect()
        df = read_core(spark, str(tmp_path), CsvLayout())
        assert df.count() == sum(300 + n for n in range(6))
        assert df.select("ID", "FILE").distinct().count() == df.count()
    finally:
        spark.conf.set(setting, old)
    for row in audit:
        n = int(row.FILE[0])
        assert row.HEADER == HEADER.replace("FI", f"FI{n}")
        assert row.LINES == 301 + n


def test_wrong_width_is_rejected(spark, tmp_path):
    header = ",".join(S.CORE_COLUMNS[:19])
    write(tmp_path, "a", "19.csv", lines_of(line(1, width=19), header=header))
    with pytest.raises(ValueError, match="(?s)without .18, 20. columns.*19.csv"):
        read_core(spark, str(tmp_path))


def test_files_without_rows_are_rejected(spark, tmp_path):
    write(tmp_path, "a", "1.csv", lines_of(line(1)))
    write(tmp_path, "a", "empty.csv", HEADER + "\n")
    with pytest.raises(ValueError, match="(?s)without data rows.*empty.csv"):
        read_core(spark, str(tmp_path))


def test_files_without_a_byte_are_rejected(spark, tmp_path):
    write(tmp_path, "a", "1.csv", lines_of(line(1)))
    write(tmp_path, "a", "nothing.csv", "")
    with pytest.raises(ValueError, match="(?s)empty CSV files.*nothing.csv"):
        read_core(spark, str(tmp_path))


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "a").mkdir()
    with pytest.raises(FileNotFoundError, match="no CSV files in the subfolders"):
        read_core(spark, str(tmp_path))


def test_empty_folder_is_skipped_with_a_warning(spark, tmp_path, caplog):
    write(tmp_path, "a", "1.csv", lines_of(line(1)))
    write(tmp_path, "b", "notes.txt", "x")
    write(tmp_path / "a", "deep", "no.csv", lines_of(line(2)))
    (tmp_path / "no.csv").write_text(lines_of(line(3)))
    with caplog.at_level(logging.WARNING):
        assert names(read_core(spark, str(tmp_path))) == {"1": "ANA"}
    assert "folder b" in caplog.text


def test_ragged_lines(spark, tmp_path):
    write(tmp_path, "a", "1.csv", "x,y,z\n1,2\n1,2,3\n1,2,3,4\n")
    lines = raw_lines(spark, [str(tmp_path / "a/1.csv")]).select("LINE")
    found = [tuple(r) for r in parse_lines(lines, ["x", "y", "z"]).collect()]
    assert found == [("1", "2", None), ("1", "2", "3"), ("1", "2", "3")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        parse_lines(lines, ["x", "y", "z"], fail_fast=True).collect()


def test_given_layout_needs_no_audit(spark, tmp_path):
    write(tmp_path, "a", "1.csv", lines_of(line(1, sep=";"), header=HEADER.replace(",", ";")))
    assert names(read_core(spark, str(tmp_path), CsvLayout(delimiter=";"))) == {"1": "ANA"}


def test_always_clean(spark, tmp_path):
    write(tmp_path, "a", "1.csv", lines_of(line(1, 'O"HARA'), line(2, '""ANA, B""')))
    assert names(read_core(spark, str(tmp_path), always_clean=True)) == {
        "1": "O'HARA", "2": "ANA, B"}


def test_clean_line(values):
    texts = ['"a,""b,c"",d"', '""b"",x', 'a,b"c,"d"', '"', '""', "a", None, 'x,"y","z"']
    assert values(texts, clean_line) == [
        'a,"b,c",d', '"b",x', "a,b'c,\"d\"", "", "", "a", None, 'x,"y","z"']
    assert values(texts[2:3] + ['"a,b"c"'], lambda x: clean_line(x, every=False)) == [
        'a,b"c,"d"', "a,b'c"]
    assert values(['"a","","O"X"', '"a","b, c",""', '"""a"",""b"",c"', 'a,"b'],
                  lambda x: clean_line(x, width=3)) == [
        '"a","","O\'X"', '"a","b, c",""', '"a","b",c', "a,'b"]
    assert values(['"a|""b|c""|d"'], lambda x: clean_line(x, "|")) == ['a|"b|c"|d']


# --- inventory -----------------------------------------------------------

def test_inventory_names_every_file(spark, tmp_path):
    write(tmp_path, "a ñ+%[1]", "1.csv", lines_of(line(1)))
    write(tmp_path, "a ñ+%[1]", "B.CSV", lines_of(line(2)))
    write(tmp_path, "a ñ+%[1]", ".2.csv", lines_of(line(3)))
    write(tmp_path, "b", "_3.Csv", lines_of(line(4)))
    write(tmp_path, "b", "nothing.csv", "")
    write(tmp_path, "b", "notes.txt", "x")
    write(tmp_path, "b", ".3.csv.crc", "x")
    (tmp_path / "c").mkdir()
    found = {r.FILE: r for r in core_files(spark, str(tmp_path)).collect()}
    assert {name: r.KIND for name, r in found.items()} == {
        "1.csv": "read", "B.CSV": "read", ".2.csv": "hidden", "_3.Csv": "hidden",
        "nothing.csv": "empty", "notes.txt": "other", ".3.csv.crc": "mark"}
    assert found["1.csv"].HEADER == HEADER and found["1.csv"].WIDTH == 20
    assert found["1.csv"].FOLDER == "a ñ+%[1]"


def test_upper_case_suffixes_are_read(spark, tmp_path):
    write(tmp_path, "a", "B.CSV", lines_of(line(1)))
    write(tmp_path, "a", "c.Csv", lines_of(line(2)))
    df = read_core(spark, str(tmp_path))
    assert names(df) == {"1": "ANA", "2": "ANA"}
    assert unread_files(core_files(spark, str(tmp_path)), df).collect() == []
    assert unread_files(core_files(spark, str(tmp_path)), df.where("ID = '1'")).count() == 1


def test_only_the_first_block_is_read_for_the_layout(spark, tmp_path):
    for n in range(3):
        write(tmp_path, "a", f"{n}.csv", lines_of(*[line(i) for i in range(20_000)]))
    files = core_files(spark, str(tmp_path)).collect()
    assert all(r.BYTES > 10 * FIRST_BLOCK and r.BYTES_READ == FIRST_BLOCK for r in files)


@pytest.mark.parametrize("text,has_rows,header", [
    ("a,b", False, "a,b"), ("a,b\n", False, "a,b"), ("a,b\r\n \n\t", False, "a,b"), ("a,b\rc", True, "a,b"),
    ("a" * 200_000 + "\nb", True, "a" * 200_000), ("a\n" + "\n" * 200_000, False, "a"),
    ("a\n" + " \n" * 200_000 + "b", True, "a"), ("\n\nb", True, "")])
def test_first_lines(spark, tmp_path, text, has_rows, header):
    write(tmp_path, "a", "1.csv", text)
    (row,) = core_files(spark, str(tmp_path)).collect()
    assert (row.HAS_ROWS, row.HEADER) == (has_rows, header)


def test_one_scan_for_all_layouts(spark, tmp_path):
    n = 0
    for sep in ",;\t|":
        for width in (18, 20):
            header = sep.join(S.CORE_COLUMNS[:width])
            write(tmp_path, f"f{n}", "1.csv", lines_of(line(n, sep=sep, width=width), header=header))
            n += 1
    df = read_core(spark, str(tmp_path))
    assert len(names(df)) == 8
    assert {r.FI for r in df.where("ID % 2 = 0").collect()} == {None}
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan csv") == 1


# --- line breaks in fields -----------------------------------------------

def record_fields(i):
    """Fields with line breaks, quotes and delimiters, of sizes from none to more than a split."""
    return [str(i), 'x""y' if i % 3 == 0 else "", "\n" * (i % 4), "a,\nb\r\nc" * (i % 5),
            "long\n" * (300 if i % 17 == 0 else 0)]


@pytest.mark.parametrize("split", ["300", "1000", "7000", "128m"])
def test_records_are_the_same_at_any_split_size(spark, tmp_path, split):
    expected = {}
    for f in range(3):
        rows = []
        for i in range(120):
            fields = ",".join(f'"{x}"' for x in record_fields(i + f))
            rows.append(fields)
        end = "\r\n" if f == 1 else "\n"
        (tmp_path / f"{f}.csv").write_bytes(
            ('"he""ad\ner",b' + end + end.join(rows) + (end if f else "")).encode())
        for r in rows:
            expected[r] = expected.get(r, 0) + 1
    setting = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(setting)
    try:
        spark.conf.set(setting, split)
        df = quoted_records(spark, [f"{tmp_path}/*.csv"])
        found = {}
        for row in df.collect():
            text = row.RECORD.removesuffix("\r")
            found[text] = found.get(text, 0) + 1
        assert found == expected
        if split == "1000":
            assert df.rdd.getNumPartitions() > 20
    finally:
        spark.conf.set(setting, old)


def test_policy_rows_with_line_breaks_are_read_in_splits(spark, tmp_path):
    rows = [line(i, f'"ANA\n""{i}"", X"' if i % 2 else "ANA") for i in range(400)]
    write(tmp_path, "a", "1.csv", lines_of(*rows))
    write(tmp_path, "b", "2.csv", lines_of(
        *[line(1000 + i, '"Ñ\r\n"', sep=";", width=18) for i in range(50)],
        header=";".join(S.CORE_COLUMNS[:18])), "iso-8859-1")
    setting = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "2000")
        found = names(read_core(spark, str(tmp_path), quoted_newlines=True))
    finally:
        spark.conf.set(setting, old)
    assert found == {
        **{str(i): f'ANA\n"{i}", X' if i % 2 else "ANA" for i in range(400)},
        **{str(1000 + i): "Ñ\r\n" for i in range(50)}}


def test_guarded_sources_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """One file for a sixth of all policies would be one task's, however many they are."""
    from verification import queries

    def guards(name):
        root = str(tmp_path / name)
        monkeypatch.setattr(queries, "scratch_folder", lambda _: root)
        return sorted(queries.source_guards(spark, SF_DIR).collect())

    one = guards("one")
    monkeypatch.setattr(queries, "ROWS_PER_DELIVERY", 50)
    assert guards("many") == one and len(one) == 8
    for case, file in (("good", "1.csv"), ("hidden", "_3.csv"), ("narrow", "7.csv")):
        assert len(list((tmp_path / "many" / case).glob(f"*/{file}"))) > 1
