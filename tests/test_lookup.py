"""Looking up documents: only files that can hold them are read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from covermonth.operators.reports import order_by_document
from covermonth.sinks.tables import FILE_INDEX, published, write_report
from covermonth.sources.lookup import MAX_VALUES, files_with, find_documents


@pytest.fixture(params=[False, True], ids=["rename", "log"])
def report(spark, tmp_path, request):
    """A report in document order over eight files, the documents 100 to 299 and NULL."""
    document = F.when(F.col("id") % 50 != 0, (100 + F.col("id") % 200).cast("string"))
    df = spark.range(0, 4000, 1, 4).select(
        document.alias("NRO_DOCUMENTO"), F.lit("2020-01-01").cast("date").alias("F_OCURRENCIA"), "id")
    path = f"{tmp_path}/with space/r.parquet"
    write_report(order_by_document(df, 8), path, by_log=request.param, lookup_by="NRO_DOCUMENTO")
    return path


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_rows_and_files(spark, report):
    everything = spark.read.parquet(published(spark, report))
    files = everything.inputFiles()
    assert len(files) == 8
    for documents in (["101"], ["101", "298"], [None], [None, "150"], ["101", "000", "99999"]):
        found = find_documents(spark, report, documents)
        assert found.columns == everything.columns
        wanted = [d for d in documents if d is not None]
        expected = everything.where(F.col("NRO_DOCUMENTO").isin(wanted) | (
            F.col("NRO_DOCUMENTO").isNull() & F.lit(None in documents)))
        assert ids(found) == ids(expected)
        assert len(found.inputFiles()) <= 2 * len(documents)


def test_no_document(spark, report):
    assert find_documents(spark, report, ["000"]).isEmpty()
    assert find_documents(spark, report, []).isEmpty()
    assert files_with(spark, published(spark, report), ["000"]) == []
    with pytest.raises(ValueError, match="join"):
        find_documents(spark, report, ["1"] * (MAX_VALUES + 1))


def test_report_without_index(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(20).select(F.col("id").cast("string").alias("NRO_DOCUMENTO"), "id"), path)
    assert files_with(spark, path, ["1"]) is None
    assert ids(find_documents(spark, path, ["1", "7"])) == [1, 7]


def test_a_replaced_report_has_its_own_index(spark, report):
    new = spark.range(5).select(F.lit("777").alias("NRO_DOCUMENTO"), F.lit(None).cast("date").alias(
        "F_OCURRENCIA"), "id")
    write_report(new, report, lookup_by="NRO_DOCUMENTO")
    assert ids(find_documents(spark, report, ["777"])) == [0, 1, 2, 3, 4]
    assert find_documents(spark, report, ["101"]).isEmpty()
    index = spark.read.parquet(f"{published(spark, report)}/{FILE_INDEX}")
    assert index.agg(F.sum("rows")).first()[0] == 5
