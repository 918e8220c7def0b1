"""Sinks, layered and direct runs, reprocessing and sorting."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.__main__ import main
from covermonth.operators.core import consolidate_core
from covermonth.plans import layers
from covermonth.plans.layers import Paths
from covermonth.sinks.storage import publish, staging_path
from covermonth.sinks.tables import report_name, reprocessed_name, write_report
from covermonth.sources.csv_files import read_core
from covermonth.sources.parquet_files import check_report, read_consolidated, report_paths
from verification import queries
from verification.files import in_parts, write_claims_workbooks, write_core_folders
from verification.inputs import RUN_DATE, claims_raw, core_raw
from conftest import SF_DIR


def part_files(path):
    return sorted(path.glob("part-*.parquet"))


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sources")
    write_core_folders(core_raw(spark, SF_DIR), f"{root}/core", [{}, {"sep": ";"}])
    write_claims_workbooks(claims_raw(spark, SF_DIR), f"{root}/claims")
    return root


@pytest.fixture(scope="module")
def reports(spark, sources, tmp_path_factory):
    """Reports of a direct run."""
    folder = tmp_path_factory.mktemp("reports")
    paths = Paths(f"{sources}/core", f"{sources}/claims", reports=str(folder))
    layers.run_direct(spark, paths, run_date=RUN_DATE)
    return folder


def same_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_parquet_layout(spark, tmp_path):
    df = spark.range(0, 500_000, 1, 1).selectExpr("cast(id AS string) NRO_DOCUMENTO")
    assert write_report(df, f"{tmp_path}/r.parquet", row_group_rows=120_000) == 500_000
    (file,) = part_files(tmp_path / "r.parquet")
    meta = pq.ParquetFile(file).metadata
    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
    assert [g.num_rows for g in groups] == [120_000] * 4 + [20_000]
    assert groups[0].column(0).compression == "ZSTD"
    assert groups[0].column(0).is_stats_set


def test_split_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).toDF("n")
    write_report(df, f"{tmp_path}/many.parquet", max_rows_per_file=100)
    assert len(part_files(tmp_path / "many.parquet")) == 12


def test_failed_write_leaves_the_old_report(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        write_report(spark.range(5).selectExpr("if(id = 4, raise_error('boom'), id) id"), path)
    with pytest.raises(ValueError, match="no rows"):
        write_report(spark.range(0), path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["r.parquet"]
    assert write_report(spark.range(4), path) == 4
    assert spark.read.parquet(path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["r.parquet"]


def test_publish_without_staged_data_restores(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(3), path)
    staged = staging_path(path)
    (tmp_path / staged.split("/")[-2]).mkdir()
    with pytest.raises(Exception):
        publish(spark, staged, path)
    assert spark.read.parquet(path).count() == 3


def test_names():
    assert report_name(S.BASE_CORE, "2024-01-31") == "Consolidado_Emision_Core_20240131.parquet"
    assert report_name(S.BASE_CLAIMS, "2024-01-31") == (
        "Consolidado_Emision_Siniestros_20240131.parquet")
    assert reprocessed_name("X.parquet") == "X_Reproceso.parquet"


def test_layered_run_equals_direct_run(spark, sources, reports, tmp_path):
    paths = Paths(f"{sources}/core", f"{sources}/claims", f"{tmp_path}/lake", f"{tmp_path}/gold")
    rows = layers.run_layers(spark, paths, run_date=RUN_DATE)
    assert set(rows) == {(la, so) for la in layers.ALL_LAYERS for so in layers.ALL_SOURCES}
    assert rows["silver", "core"] == rows["gold", "core"]
    assert same_rows(read_consolidated(spark, paths.reports), read_consolidated(spark, str(reports)))
    # Later layers alone start from the tables in the lake.
    again = layers.run_layers(
        spark, paths, ("gold",), ("claims",), run_date=RUN_DATE,
        options=layers.Options(drop_optional=True))
    assert again == {("gold", "claims"): rows["gold", "claims"]}
    claims = spark.read.parquet(f"{paths.reports}/{report_name(S.BASE_CLAIMS, RUN_DATE)}")
    assert claims.columns == [c for c in S.CONSOLIDATED_COLUMNS if c not in ("PARENTESCO", "FI")]


def test_gold_is_in_document_order(spark, sources, tmp_path):
    paths = Paths(core=f"{sources}/core", lake=f"{tmp_path}/lake", reports=f"{tmp_path}/gold")
    layers.run_layers(spark, paths, sources=("core",), run_date=RUN_DATE)
    keys = []
    for file in part_files(tmp_path / "gold" / report_name(S.BASE_CORE, RUN_DATE)):
        table = pq.read_table(file, columns=["NRO_DOCUMENTO", "F_OCURRENCIA"]).to_pylist()
        keys += [(r["NRO_DOCUMENTO"], r["F_OCURRENCIA"]) for r in table]
    assert keys == sorted(keys)


def test_direct_run_with_and_without_optional_columns(spark, sources, reports, tmp_path):
    paths = Paths(core=f"{sources}/core", reports=str(tmp_path))
    layers.run_direct(spark, paths, ("core",), RUN_DATE)
    name = report_name(S.BASE_CORE, RUN_DATE)
    assert same_rows(spark.read.parquet(f"{tmp_path}/{name}"),
                     spark.read.parquet(f"{reports}/{name}"))
    layers.run_direct(spark, paths, ("core",), RUN_DATE,
                      layers.Options(always_clean=True, drop_optional=True))
    assert len(spark.read.parquet(f"{tmp_path}/{name}").columns) == 12


def test_missing_folders_are_errors(spark, sources, tmp_path):
    with pytest.raises(FileNotFoundError, match="core folder"):
        layers.run_layers(spark, Paths(f"{tmp_path}/no", lake=f"{tmp_path}/lake"), sources=("core",))
    with pytest.raises(FileNotFoundError, match="report folder"):
        layers.run_direct(spark, Paths(f"{sources}/core", reports=f"{tmp_path}/no"), ("core",))
    with pytest.raises(ValueError, match="no claims folder given"):
        layers.run_layers(spark, Paths(lake=f"{tmp_path}/lake"), sources=("claims",))
    with pytest.raises(ValueError, match="choose from"):
        layers.run_layers(spark, Paths(), ("copper",))
    with pytest.raises(FileNotFoundError, match="no Parquet reports"):
        report_paths(spark, str(tmp_path))


def test_layers_without_earlier_tables_are_skipped(spark, tmp_path):
    paths = Paths(lake=f"{tmp_path}/lake", reports=f"{tmp_path}/gold")
    assert layers.run_layers(spark, paths, ("silver", "gold"), run_date=RUN_DATE) == {}


def test_reprocess(spark, reports, tmp_path):
    rows = layers.reprocess_reports(spark, str(reports), str(tmp_path))
    source = read_consolidated(spark, str(reports))
    name = reprocessed_name(report_name(S.BASE_CLAIMS, RUN_DATE))
    result = spark.read.parquet(f"{tmp_path}/{name}")
    assert result.columns == S.REPROCESSED_COLUMNS
    assert rows == source.count() == result.count()
    assert same_rows(result.drop("ULT_DIGI_DOC"), source)
    with pytest.raises(ValueError, match="wrong number of columns"):
        layers.reprocess_reports(spark, str(tmp_path), f"{tmp_path}/other")
    with pytest.raises(ValueError, match="folder of their own"):
        layers.reprocess_reports(spark, str(tmp_path), f"{tmp_path}/")


def test_sort(spark, reports, tmp_path):
    rows = layers.sort_reports(spark, str(reports), str(tmp_path), partitions=5)
    files = part_files(tmp_path / "Archivo_Consolidado_Ordenado.parquet")
    assert len(files) == 5
    keys = []
    for file in files:
        table = pq.read_table(file, columns=["NRO_DOCUMENTO", "F_OCURRENCIA"]).to_pylist()
        keys += [(r["NRO_DOCUMENTO"], r["F_OCURRENCIA"]) for r in table]
    assert keys == sorted(keys)
    assert len(keys) == rows
    assert same_rows(spark.read.parquet(*report_paths(spark, str(tmp_path))),
                     read_consolidated(spark, str(reports)))


def test_sort_of_one_row_copied_many_times(spark, tmp_path):
    """Copies of one row are told apart by their row number, so they spread."""
    row = consolidate_core(core_raw(spark, SF_DIR), RUN_DATE).limit(1)
    copies = row.select("*", F.explode(F.sequence(F.lit(1), F.lit(20_000)))).drop("col")
    write_report(copies, f"{tmp_path}/in/r.parquet")
    assert layers.sort_reports(spark, f"{tmp_path}/in", f"{tmp_path}/out", 4) == 20_000
    sizes = [pq.ParquetFile(f).metadata.num_rows
             for f in part_files(tmp_path / "out" / "Archivo_Consolidado_Ordenado.parquet")]
    assert len(sizes) == 4
    assert max(sizes) < 10_000


def test_sort_ranges_fit_into_the_memory_of_a_task(spark):
    rows = 40_000_000
    assert layers._sort_ranges(spark.range(rows)) * 2_000_000 >= rows


def test_number_of_sort_ranges_follows_from_the_rows(spark, reports, monkeypatch):
    df = read_consolidated(spark, str(reports))
    assert layers._sort_ranges(df) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(layers, "_RANGE_BYTES", layers._RAW_ROW_BYTES * 1000)
    assert layers._sort_ranges(df) == df.count() // 1000 + 1


def test_options_reach_the_readers_and_the_rules(spark, tmp_path):
    folder = tmp_path / "core" / "a"
    folder.mkdir(parents=True)
    fields = ["1", "1", "R", "P", "P1", "C", "T", "E", "ANA", "12345678", "", *["01/01/30"] * 9]
    (folder / "1.csv").write_text("\n".join([
        ",".join(S.CORE_COLUMNS), ",".join(fields), ",".join(fields[:5])]))
    paths = Paths(core=f"{tmp_path}/core", lake=f"{tmp_path}/lake", reports=f"{tmp_path}/out")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        layers.run_layers(spark, paths, ("bronze",), ("core",),
                          options=layers.Options(fail_fast=True))
    years = {}
    for pivot in (20, 69):
        options = layers.Options(year_pivot=pivot, fmt="orc")
        layers.run_layers(spark, paths, ("bronze", "silver"), ("core",), RUN_DATE, options=options)
        silver = spark.read.orc(f"{tmp_path}/lake/silver/core")
        years[pivot] = {r.F_OCURRENCIA.year for r in silver.collect()}
    assert years == {20: {1930}, 69: {2030}}


def test_report_checks(spark, tmp_path):
    write_report(spark.range(3), f"{tmp_path}/a.parquet")
    with pytest.raises(ValueError, match="wrong number of columns.*: 1, expected 14"):
        check_report(spark, f"{tmp_path}/a.parquet", S.CONSOLIDATED_COLUMNS)
    spark.range(0).write.parquet(f"{tmp_path}/b.parquet")
    with pytest.raises(ValueError, match="no rows"):
        check_report(spark, f"{tmp_path}/b.parquet", ["id"])


def test_command_line(spark, sources, reports, tmp_path):
    main(["direct", "--core", f"{sources}/core", "--reports", str(tmp_path),
          "--sources", "core", "--run-date", RUN_DATE])
    name = report_name(S.BASE_CORE, RUN_DATE)
    assert same_rows(spark.read.parquet(f"{tmp_path}/{name}"),
                     spark.read.parquet(f"{reports}/{name}"))
    main(["sort", "--reports", str(tmp_path), "--target", f"{tmp_path}/sorted"])
    assert len(report_paths(spark, f"{tmp_path}/sorted")) == 1
    with pytest.raises(SystemExit):
        main(["layers", "--sources", "core"])


def test_sort_of_reports_with_and_without_optional_columns(spark, reports, tmp_path):
    source = read_consolidated(spark, str(reports))
    core, claims = (source.where(f"BASE = '{base}'") for base in (S.BASE_CORE, S.BASE_CLAIMS))
    write_report(core, f"{tmp_path}/in/a.parquet")
    write_report(claims, f"{tmp_path}/in/b.parquet", drop_optional=True)
    layers.sort_reports(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    (path,) = report_paths(spark, f"{tmp_path}/out")
    assert same_rows(spark.read.parquet(path), source)


def test_policy_folders_make_each_row_once(spark, tmp_path, monkeypatch):
    """The rows of a folder are made for it alone, and are those the whole is cut into."""
    keys = [*range(200), 1, 2, None, None, -1, -2]
    days = "timestamp'2020-01-31' + make_interval(0, 0, 0, i)"
    orders = spark.createDataFrame([*enumerate(keys)], "i int, o_orderkey bigint").selectExpr(
        "o_orderkey", "if(i = 4, null, cast(i AS bigint)) o_custkey", f"{days} o_orderdate",
        "'1-URGENT' o_orderpriority")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    made = []

    def recorded(spark, sf, part=None):
        made.append(part)
        return core_raw(spark, sf, part)

    monkeypatch.setattr(queries.inputs, "core_raw", recorded)
    monkeypatch.setattr(queries, "write_claims_workbooks", lambda *_: None)
    monkeypatch.setattr(queries.inputs, "claims_raw", lambda *_: None)
    paths = queries._source_folders(spark, str(tmp_path), f"{tmp_path}/sources")
    assert made == [(2, 0), (2, 1)]
    found = read_core(spark, paths.core)
    for i, part in enumerate(in_parts(core_raw(spark, str(tmp_path)), 2)):
        ids = sorted(row.ID for row in part.select("ID").collect())
        folder = found.where(F.col("FOLDER") == f"carpeta {i}")
        assert sorted(row.ID for row in folder.select("ID").collect()) == ids != []
        alone = core_raw(spark, str(tmp_path), (2, i))
        assert same_rows(alone, part)
