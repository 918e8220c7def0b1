"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, queries
from conftest import SF_DIR
from verification.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toArrow()
    expected = duck.sql(ORACLE[name]).to_arrow_table()
    assert sorted(found.column_names) == sorted(expected.column_names)
    assert found.num_rows == expected.num_rows > 0
    columns = ", ".join(f'"{c}"' for c in sorted(found.column_names))
    found, expected = found.select(sorted(found.column_names)), expected
    for a, b in (("found", "expected"), ("expected", "found")):
        diff = duck.sql(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b}")
        assert diff.limit(3).fetchall() == []


def test_entry(spark):
    assert entry(spark).count() > 0
