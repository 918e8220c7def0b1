"""Plans stay small, free of needless shuffles, and free of Python."""

from __future__ import annotations

import time

import pytest

from covermonth.operators.claims import consolidate_claims
from covermonth.operators.core import consolidate_core, consolidate_core_strict
from covermonth.sources.csv_files import audit_csv_files, core_pattern
from verification.files import write_csv
from verification.inputs import claims_raw, core_raw
from conftest import SF_DIR

# Methods with more byte code are not compiled by the JVM's compiler.
COMPILED_METHOD_BYTES = 8000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")
    core_raw(spark, SF_DIR).write.parquet(f"{root}/core")
    claims_raw(spark, SF_DIR).write.parquet(f"{root}/claims")
    return spark.read.parquet(f"{root}/core"), spark.read.parquet(f"{root}/claims")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def largest_method(spark, df):
    """Byte code size of the largest generated method; 0 if none is generated."""
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    stages = getattr(debug, "MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max([stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())], default=0)


def test_core_needs_no_shuffle_and_plans_fast(tables):
    start = time.perf_counter()
    plan = plan_of(consolidate_core(tables[0], "2024-01-01"))
    assert time.perf_counter() - start < 10
    df = consolidate_core(tables[0], "2024-01-01")
    start = time.perf_counter()
    plan_of(df)
    assert time.perf_counter() - start < 3
    assert "Exchange" not in plan
    assert "Python" not in plan and "BatchEval" not in plan
    for unread in ("CONTRATANTE", "F_INI_POLIZA", "PRODUCTO", "ID"):
        assert f"{unread}:string" not in plan.split("ReadSchema")[-1]


def test_claims_shuffle_once(tables):
    plan = plan_of(consolidate_claims(tables[1], "2024-01-01"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2
    shuffled = plan.split("Exchange hashpartitioning(")[1].split("),")[0]
    assert "F_OCURRENCIA" not in shuffled and "FECHA_REGISTRO" not in shuffled
    assert "Python" not in plan


def test_generated_code_is_small_enough_to_compile(spark, tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        core = largest_method(spark, consolidate_core(tables[0], "2024-01-01"))
        strict = largest_method(spark, consolidate_core_strict(tables[0], "2024-01-01"))
        claims = largest_method(spark, consolidate_claims(tables[1], "2024-01-01"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < core < COMPILED_METHOD_BYTES
    assert 0 < strict < COMPILED_METHOD_BYTES
    assert 0 < claims < COMPILED_METHOD_BYTES


def test_audit_does_not_sort_the_lines(spark, tmp_path):
    write_csv(core_raw(spark, SF_DIR), f"{tmp_path}/a")
    plan = plan_of(audit_csv_files(spark, [core_pattern(str(tmp_path))]))
    assert "ObjectHashAggregate" in plan
    assert "Sort" not in plan.replace("array_sort", "").replace("SortArray", "")
