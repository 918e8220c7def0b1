"""Raw policy and claims rows derived from the given tables.

The given tables hold no policies or claims, so the raw extracts are derived
from ``orders`` and ``lineitem`` by SQL that Spark and DuckDB read alike. Each
class of order key exercises one rule; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth.plans.barrier import stage_barrier

RUN_DATE = "2024-01-01"
ROWS_PER_TASK = 500_000

CORE_RAW_SQL = """
WITH b AS (
  SELECT o_orderkey k, cast(o_custkey AS string) c, o_orderpriority pr,
         cast(o_orderdate AS date) d0,
         cast(o_orderdate AS date) + cast((o_orderkey * 37) % 1500 - 20 AS int) d1
  FROM {orders}),
t AS (
  SELECT *,
    cast(year(d0) AS string)||'-'||lpad(cast(month(d0) AS string),2,'0')||'-'||lpad(cast(day(d0) AS string),2,'0') iso0,
    lpad(cast(day(d0) AS string),2,'0')||'/'||lpad(cast(month(d0) AS string),2,'0')||'/'||cast(year(d0) AS string) dmy0,
    cast(year(d1) AS string)||'-'||lpad(cast(month(d1) AS string),2,'0')||'-'||lpad(cast(day(d1) AS string),2,'0') iso1,
    lpad(cast(day(d1) AS string),2,'0')||'/'||lpad(cast(month(d1) AS string),2,'0')||'/'||cast(year(d1) AS string) dmy1
  FROM b),
f AS (
  SELECT *,
    CASE WHEN k%3=0 THEN iso0 ELSE dmy0 END ini,
    CASE WHEN k%20=11 THEN '2103-06-19' WHEN k%20=12 THEN NULL WHEN k%20=16 THEN dmy0
         WHEN k%20=17 THEN '2150-01-01' WHEN k%5=0 THEN iso1 ELSE dmy1 END fin,
    CASE WHEN k%20 IN (4,8) THEN NULL WHEN k%20=9 THEN '  '
         WHEN k%20=5 THEN '20'||lpad(c,9,'0') WHEN k%20=7 THEN 'PAS'||c
         WHEN k%20=10 THEN lpad(c,5,'1') WHEN k%20=18 THEN lpad(c,9,'7')
         WHEN k%20=19 THEN 'X-'||c ELSE lpad(c,8,'4') END dni,
    CASE WHEN k%20 IN (4,5,6,9) THEN '10'||lpad(c,9,'0') WHEN k%20=8 THEN 'CE'||c ELSE NULL END ruc
  FROM t)
SELECT cast(k AS string) ID, cast(k%7 AS string) COD_RAMO, 'RAMO' RAMO, pr PRODUCTO,
  'P'||cast(k AS string) POLIZA, c CERTIFICADO, 'T' TIPO, 'EMPRESA' CONTRATANTE, ' NOMBRE ' ASEGURADO,
  CASE WHEN k%20 IN (0,1,2,3) THEN 'PEREZ' ELSE dni END DNI_ASEGURADO,
  CASE WHEN k%20=0 THEN lpad(c,8,'4') WHEN k%20=1 THEN NULL WHEN k%20=2 THEN 'CE'||c
       WHEN k%20=3 THEN 'GOMEZ' ELSE ruc END RUC_ASEGURADO,
  CASE WHEN k%20 IN (0,2) THEN NULL WHEN k%20=1 THEN '10'||lpad(c,9,'0')
       WHEN k%20=3 THEN lpad(c,8,'4') ELSE dmy0 END F_EMISION_POLIZA,
  CASE WHEN k%20=3 THEN NULL ELSE iso0 END F_EMISION_CERT,
  dmy0 F_INI_POLIZA, iso0 F_FIN_POLIZA,
  CASE WHEN k%20=3 THEN ini ELSE NULL END F_ANULACION_CERT,
  CASE WHEN k%20 IN (0,1,2) THEN NULL WHEN k%20=13 THEN 'N/A' WHEN k%20=14 THEN '01/01/1800'
       WHEN k%20=15 THEN fin ELSE ini END F_INI_COBER,
  CASE WHEN k%20 IN (0,1,2) THEN ini WHEN k%20=3 THEN NULL WHEN k%20=15 THEN ini ELSE fin END F_FIN_COBERT,
  CASE WHEN k%20 IN (0,1,2,3) THEN fin ELSE 'TITULAR' END PARENTESCO,
  CASE WHEN k%20 IN (0,1,2,3) THEN 'TITULAR' ELSE 'FI' END FI
FROM f
"""

CLAIMS_RAW_SQL = """
SELECT
  CASE WHEN l_orderkey%10=0 THEN '12' WHEN l_orderkey%10=1 THEN NULL
       WHEN l_orderkey%10=2 THEN '  1.2.'||cast(o_custkey AS string)||'-5 '
       WHEN l_orderkey%10=3 THEN 'CE-'||cast(o_custkey AS string)
       ELSE lpad(cast(o_custkey AS string),7,'3') END DNI,
  cast(l_linenumber AS string) RAMO,
  'P'||cast(o_custkey%50 AS string) POLIZA,
  cast(l_suppkey%5 AS string) CERTIFICADO,
  CASE WHEN l_orderkey%11=0 THEN 'AB' ELSE ' ASEGURADO '||cast(o_custkey AS string) END ASEGURADO,
  CASE WHEN l_orderkey%13=0 THEN '2200-02-03' WHEN l_orderkey%13=1 THEN 'sin fecha'
       WHEN l_orderkey%13=2 THEN NULL
       WHEN l_orderkey%2=0 THEN cast(year(o_orderdate) AS string)||'-'||lpad(cast(month(o_orderdate) AS string),2,'0')||'-01 00:00:00'
       ELSE lpad(cast(day(o_orderdate) AS string),2,'0')||'/'||lpad(cast(month(o_orderdate) AS string),2,'0')||'/'||cast(year(o_orderdate) AS string)
  END OCURRENCIA
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

# Every order date in each of the eight formats, and texts that fit none.
DATE_TEXTS_SQL = """
WITH d AS (
  SELECT o_orderkey k, year(o_orderdate) y, month(o_orderdate) m, day(o_orderdate) d
  FROM {orders}),
t AS (
  SELECT k,
    cast(y AS string) yyyy, lpad(cast(y%100 AS string),2,'0') yy,
    cast(m AS string) m, lpad(cast(m AS string),2,'0') mm,
    cast(d AS string) d, lpad(cast(d AS string),2,'0') dd
  FROM d)
SELECT k, CASE k%16
  WHEN 0 THEN yyyy||'-'||mm||'-'||dd WHEN 1 THEN dd||'/'||mm||'/'||yyyy
  WHEN 2 THEN dd||'-'||mm||'-'||yyyy WHEN 3 THEN yyyy||'/'||mm||'/'||dd
  WHEN 4 THEN dd||'/'||mm||'/'||yy WHEN 5 THEN dd||'-'||mm||'-'||yy
  WHEN 6 THEN yy||'/'||mm||'/'||dd WHEN 7 THEN yy||'-'||mm||'-'||dd
  WHEN 8 THEN d||'/'||m||'/'||yyyy WHEN 9 THEN yyyy||'-'||mm||'-'||dd||' 10:00:00'
  WHEN 10 THEN '31/02/'||yyyy WHEN 11 THEN ''
  WHEN 12 THEN yyyy||mm||dd WHEN 13 THEN dd||'/'||mm||'-'||yyyy
  WHEN 14 THEN NULL ELSE 'sin fecha' END TEXTO
FROM t
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, always dealt to all cores, and to more tasks the more rows it has.

    The given files are single row groups, which one task reads, and a row
    expands to very many. This shuffle belongs to the queries' input, not to the engine. Rows are
    dealt by hashes of their numbers in the files; without numbers Spark would sort them first.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tasks = max(spark.sparkContext.defaultParallelism, df.count() // ROWS_PER_TASK + 1)
    place = F.pmod(F.xxhash64("_metadata.row_index"), F.lit(tasks))
    return df.repartitionById(tasks, place.cast("int"))


def core_raw(
    spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None
) -> DataFrame:
    """Raw policies; with ``part`` (n, i), the i-th of n parts by order: no other rows are made."""
    orders = table(spark, sf_dir, "orders")
    if part is not None:
        orders = orders.where(f"o_orderkey % {part[0]} = {part[1]}")
    return stage_barrier(spark.sql(CORE_RAW_SQL, orders=orders))


def claims_raw(
    spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None
) -> DataFrame:
    """Raw claims; with ``part`` (n, i), the i-th of n parts by order."""
    lineitem = table(spark, sf_dir, "lineitem")
    if part is not None:
        lineitem = lineitem.where(f"l_orderkey % {part[0]} = {part[1]}")
    return stage_barrier(spark.sql(
        CLAIMS_RAW_SQL,
        lineitem=lineitem,
        orders=spark.read.parquet(f"{sf_dir}/orders.parquet"),
    ))


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_barrier(spark.sql(DATE_TEXTS_SQL, orders=table(spark, sf_dir, "orders")))
