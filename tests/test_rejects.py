"""Strict dates with a table of the policies that break them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.operators.core import consolidate_core, consolidate_core_strict
from covermonth.plans import layers
from covermonth.sinks.tables import layer_exists, load_layer, save_layer
from test_operators import policies

RUN_DATE = "2024-01-01"
STRICT = layers.Options(date_mode="strict", keep_rejects=True)


def bronze(spark, lake, *rows):
    raw = policies(spark, *rows).withColumn("FILE", F.lit("a.csv"))
    save_layer(layers.with_load_time(raw), lake, layers.BRONZE, layers.CORE)


def test_good_rows_are_those_of_strict_mode(spark):
    raw = policies(
        spark, {}, {"F_FIN_COBERT": None}, {"F_INI_COBER": "15/02/2020 10:00:00"},
        {"F_FIN_COBERT": "19/06/2103"}, {"F_INI_COBER": "01/01/1800"}, {"DNI_ASEGURADO": "1"})
    df = consolidate_core_strict(raw, RUN_DATE)
    assert df.where("FAULTS != 0 OR FAULTY_DATES IS NOT NULL").isEmpty()
    plain = consolidate_core(raw, RUN_DATE, date_mode="strict")
    df = df.select(*S.CONSOLIDATED_COLUMNS)
    assert df.exceptAll(plain).isEmpty() and plain.exceptAll(df).isEmpty()
    assert not plain.isEmpty()


def test_rejects_are_kept_and_counted(spark, tmp_path):
    lake = f"{tmp_path}/lake"
    bronze(spark, lake, {"POLIZA": "good"}, {"POLIZA": "iso", "F_INI_COBER": "2020-01-01"},
           {"POLIZA": "both", "F_FIN_COBERT": "", "F_ANULACION_CERT": "31/02/2020"},
           {"POLIZA": "range", "F_INI_COBER": "01/01/1800", "F_FIN_COBERT": "x"})
    with pytest.raises(layers.RejectedRows) as error:
        layers.build_silver(spark, lake, layers.CORE, RUN_DATE, STRICT)
    assert error.value.counts == {
        "policies": 3, "F_ANULACION_CERT": 1, "F_INI_COBER": 1, "F_FIN_COBERT": 2}
    assert not layer_exists(spark, lake, layers.SILVER, layers.CORE)
    rejects = load_layer(spark, lake, layers.REJECTS, layers.CORE)
    rows = {r.POLIZA: r for r in rejects.collect()}
    assert {p: r.FAULTS for p, r in rows.items()} == {"iso": 2, "both": 5, "range": 4}
    assert (rows["both"].F_FIN_COBERT, rows["both"].F_ANULACION_CERT) == ("", "31/02/2020")
    assert (rows["iso"].F_INI_COBER, rows["iso"].FILE) == ("2020-01-01", "a.csv")
    table = load_layer(spark, lake, layers.BRONZE, layers.CORE).select(
        "POLIZA", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    places = {(r.f, r.i): r.POLIZA for r in table.collect()}
    assert all(places[r.BRONZE_FILE, r.BRONZE_ROW] == p for p, r in rows.items())


def test_without_rejects_the_report_is_made(spark, tmp_path):
    lake = f"{tmp_path}/lake"
    bronze(spark, lake, {}, {"F_FIN_COBERT": "30/06/2020"})
    assert layers.build_silver(spark, lake, layers.CORE, RUN_DATE, STRICT) == 9
    assert not layer_exists(spark, lake, layers.REJECTS, layers.CORE)
    assert layers.export_gold(spark, lake, f"{tmp_path}/reports", layers.CORE, RUN_DATE) == 9
    (report,) = (tmp_path / "reports").iterdir()
    assert spark.read.parquet(str(report)).columns == S.CONSOLIDATED_COLUMNS


def test_rejects_need_strict_dates_and_layers(spark, tmp_path):
    bronze(spark, f"{tmp_path}/lake", {})
    with pytest.raises(ValueError, match="strict dates only"):
        layers.build_silver(spark, f"{tmp_path}/lake", layers.CORE, RUN_DATE,
                            layers.Options(keep_rejects=True))
    with pytest.raises(ValueError, match="layered runs only"):
        layers.run_direct(spark, layers.Paths(core="/nowhere"), options=STRICT)


def test_one_scan(spark):
    raw = policies(spark, {})
    plan = consolidate_core_strict(raw, RUN_DATE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Exchange" not in plan
