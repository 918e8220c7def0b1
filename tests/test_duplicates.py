"""Members of groups of equal keys, against counting in plain Python."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from covermonth.operators.duplicates import duplicate_members, one_of_each
from verification import inputs
from verification.queries import QUERIES
from conftest import SF_DIR

SCHEMA = "a string, b string, n int"


def counted(rows, key):
    totals = Counter(key(r) for r in rows)
    return Counter((*r, totals[key(r)]) for r in rows if totals[key(r)] > 1)


def found(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [2, 10_000])
def test_members_by_key_and_by_row(spark, hot_rows):
    rows = [(None, "x", 1), ("x", None, 1), (None, "x", 2), ("x", "x", 3), (None, None, 4),
            (None, None, 5), ("", "", 6), ("", None, 7), ("x", "x", 3), ("y", "z", 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    by_key = duplicate_members(df, ["a", "b"], hot_rows=hot_rows)
    assert by_key.columns == ["a", "b", "n", "COPIES"]
    assert found(by_key) == counted(rows, lambda r: r[:2])
    assert found(duplicate_members(df, hot_rows=hot_rows)) == counted(rows, lambda r: r)


def test_nothing_repeated_and_empty(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "c", 1)], SCHEMA)
    assert duplicate_members(df, ["a", "b"]).isEmpty()
    assert duplicate_members(df.limit(0)).isEmpty()
    with pytest.raises(ValueError, match="already"):
        duplicate_members(df, count_name="n")


def test_one_key_in_a_third_of_the_rows_is_spread(spark):
    """The rows of a hot key are joined by many tasks, and none is lost."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") / 2).cast("int").cast("string"))
    df = spark.range(0, n, 1, 16).select(key.alias("a"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        members = duplicate_members(df, ["a"])
        tasks = {r.p: r["count"] for r in members.where("a = 'hot'").groupBy(
            F.spark_partition_id().alias("p")).count().collect()}
        total = members.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(tasks.values()) == n // 3
    assert len(tasks) >= 4 and max(tasks.values()) < n // 6
    plain = Counter("hot" if i % 3 == 0 else str(i // 2) for i in range(n))
    assert total == sum(c for c in plain.values() if c > 1)


def test_one_of_each_is_the_smallest_row(spark):
    rows = [("a", "x", 3), ("a", "x", 1), ("a", None, 2), (None, "x", 5), (None, "x", 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(one_of_each(df, ["a"])) == Counter([("a", None, 2), (None, "x", 4)])
    assert one_of_each(df.limit(0), ["a"]).isEmpty()


@pytest.mark.parametrize("name", ["duplicate_members", "duplicate_keys"])
def test_registered_queries_make_their_claims_once(spark, name):
    """Several passes go over them, so they are read from a written table."""
    files = QUERIES[name](spark, SF_DIR).inputFiles()
    assert files and not any("lineitem" in file or "orders" in file for file in files)


def test_tables_are_dealt_to_more_tasks_the_more_rows_they_have(spark, monkeypatch):
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 100)
    df = inputs.table(spark, SF_DIR, "orders")
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 250 and sum(sizes) == 1500
