"""The check of the order of a sorted report."""

from __future__ import annotations

import datetime

import pytest

from verification.order import with_order

MARCH, APRIL = datetime.date(2024, 3, 1), datetime.date(2024, 4, 1)
SCHEMA = "NRO_DOCUMENTO string, F_OCURRENCIA date"


@pytest.mark.parametrize("batch", ["1", "2", "10000"])
def test_rows_out_of_order_are_found(spark, tmp_path, batch):
    files = [
        [("a", MARCH), ("a", MARCH), ("a", APRIL), ("a", None), ("b", APRIL), ("b", MARCH),
         ("a", APRIL), (None, MARCH), (None, APRIL), ("c", MARCH)],
        [(None, APRIL), (None, None)],
        [("d", MARCH), ("e", MARCH)],
    ]
    for number, rows in enumerate(files):
        df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        df.write.parquet(f"{tmp_path}/made")
        (made,) = (tmp_path / "made").glob("part-*.parquet")
        (tmp_path / "report").mkdir(exist_ok=True)
        made.rename(tmp_path / "report" / f"{number}.parquet")
        (tmp_path / "made").rename(tmp_path / f"made {number}")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = with_order(spark, spark.read.parquet(f"{tmp_path}/report")).orderBy("file", "place")
        marks = [(r.file, r.place) for r in found.collect() if not r.IN_ORDER]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found.count() == 14
    assert marks == [("0.parquet", 5), ("0.parquet", 6), ("0.parquet", 9),
                     ("2.parquet", 0), ("2.parquet", 1)]


def test_rows_are_not_moved(spark, tmp_path):
    spark.range(50_000).selectExpr("lpad(id, 8, '0') NRO_DOCUMENTO", "date'2024-01-01' F_OCURRENCIA",
                                   ).write.parquet(f"{tmp_path}/r")
    found = with_order(spark, spark.read.parquet(f"{tmp_path}/r"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan
    assert found.where("IN_ORDER").count() == 50_000
