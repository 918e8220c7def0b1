"""Registered queries: one per operator, on input derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth import schemas as S
from covermonth.functions.dates import parse_date_strict, with_parsed_dates
from covermonth.functions.text import blank_to_null, is_integer, pad_document, strip
from covermonth.operators.claims import (
    clean_claims,
    consolidate_claims,
    distinct_rows,
    with_claim_constants,
)
from covermonth.operators.core import consolidate_core
from covermonth.operators.coverage import (
    add_coverage_bounds,
    clear_placeholder_ends,
    date_range_filter,
    expand_months,
    parse_dates,
)
from covermonth.operators.documents import pad_documents, quality_filter, resolve_documents
from covermonth.operators.duplicates import duplicate_members, one_of_each
from covermonth.operators.reports import add_last_digit, union_bases
from covermonth.operators.shift import shift_repair, strip_all
from covermonth.plans import layers
from covermonth.plans.barrier import stage_barrier
from covermonth.sinks.commits import CommitConflict, commit_version, new_version
from covermonth.sinks.storage import write_text
from covermonth.sinks.tables import (
    last_commit,
    load_layer,
    published,
    replace_if_unchanged,
    save_layer,
    write_report,
)
from covermonth.sources.csv_files import (
    audit_csv_files,
    core_files,
    core_pattern,
    read_core,
    require_core_files,
)
from covermonth.sources.inventory import MARK, unread_files
from covermonth.sources.lookup import find_documents
from covermonth.sources.parquet_files import check_report, read_consolidated, report_paths
from covermonth.sources.workbooks import (
    claims_rows,
    read_workbooks,
    require_workbooks,
    skipped_sheets,
    workbook_files,
)
from verification import inputs, oracle
from verification.files import (
    ROWS_PER_WORKBOOK,
    in_parts,
    scratch_folder,
    write_claims_workbooks,
    write_core_folders,
    write_csv,
    write_deliveries,
    write_lines,
    write_named_workbooks,
)
from verification.order import with_order

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = inputs.RUN_DATE
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its oracle, under its own name if none is given."""
    def add(query: Query) -> Query:
        QUERIES[name or query.__name__] = query
        ORACLE[name or query.__name__] = sql
        return query
    return add


# --- stages of the policy pipeline ---------------------------------------

def _stripped(spark: SparkSession, sf: str) -> DataFrame:
    return strip_all(inputs.core_raw(spark, sf).drop(*S.CORE_UNUSED_COLUMNS))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    return stage_barrier(resolve_documents(pad_documents(shift_repair(_stripped(spark, sf)))))


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return parse_dates(quality_filter(_resolved(spark, sf)))


def _in_range(spark: SparkSession, sf: str) -> DataFrame:
    return date_range_filter(stage_barrier(clear_placeholder_ends(_dated(spark, sf))))


@register(oracle.core_until("core", f"SELECT {oracle.FINAL} FROM core"))
def core_consolidate(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate_core(inputs.core_raw(spark, sf), RUN_DATE)


@register(oracle.claims_until("claims", f"SELECT {oracle.FINAL} FROM claims"))
def claims_consolidate(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate_claims(inputs.claims_raw(spark, sf), RUN_DATE)


_PADDED_NAME = (
    "chr(9)||chr(160)||' '||o_orderpriority||' '||chr(8195)||cast(o_custkey AS {string})"
    "||chr(12288)||chr(10)"
)


@register(f"""SELECT o_orderkey, trim({_PADDED_NAME.format(string='varchar')}, {oracle.BLANKS})
  NOMBRE, length({_PADDED_NAME.format(string='varchar')}) N_BEFORE FROM orders""")
def strip_all_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    around = [F.lit("\t\xa0 "), F.col("o_orderpriority"), F.lit("  "),
              F.col("o_custkey").cast("string"), F.lit("　\n")]
    df = inputs.table(spark, sf, "orders").select("o_orderkey", F.concat(*around).alias("NOMBRE"))
    return df.select("o_orderkey", strip(F.col("NOMBRE")).alias("NOMBRE"),
                     F.length("NOMBRE").cast("bigint").alias("N_BEFORE"))


@register(oracle.core_until("stripped", "SELECT * FROM stripped"), name="strip_all")
def strip_core_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _stripped(spark, sf)


@register(oracle.core_until("shifted", "SELECT * FROM shifted"), name="shift_repair")
def shift_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return shift_repair(_stripped(spark, sf))


@register(oracle.core_until("padded", "SELECT * FROM padded"))
def core_documents_padded(spark: SparkSession, sf: str) -> DataFrame:
    return pad_documents(shift_repair(_stripped(spark, sf)))


@register(f"""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN cast(o_orderkey AS varchar)
    WHEN 1 THEN '-'||o_custkey WHEN 2 THEN '+'||o_custkey ELSE o_custkey||'A' END n FROM orders)
  SELECT o_orderkey, CASE WHEN length(n) BETWEEN 5 AND 7 AND try_cast(n AS bigint) IS NOT NULL
    THEN CASE WHEN n[1] IN ('+', '-') THEN n[1]||lpad(n[2:], 7, '0') ELSE lpad(n, 8, '0') END
    ELSE n END NRO FROM t""")
def doc_zero_pad(spark: SparkSession, sf: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    number = (
        F.when(key % 4 == 0, key.cast("string")).when(key % 4 == 1, F.concat(F.lit("-"), cust))
        .when(key % 4 == 2, F.concat(F.lit("+"), cust)).otherwise(F.concat(cust, F.lit("A")))
    )
    df = inputs.table(spark, sf, "orders").select("o_orderkey", number.alias("n"))
    return df.select("o_orderkey", pad_document(F.col("n"), is_integer(F.col("n"))).alias("NRO"))


@register(oracle.core_until("stripped", """SELECT POLIZA, nullif(DNI_ASEGURADO, '') DNI_ASEGURADO,
  nullif(RUC_ASEGURADO, '') RUC_ASEGURADO FROM stripped"""), name="blank_to_null")
def blanks_to_null(spark: SparkSession, sf: str) -> DataFrame:
    ids = ["DNI_ASEGURADO", "RUC_ASEGURADO"]
    return _stripped(spark, sf).select(
        "POLIZA", *[blank_to_null(F.col(c)).alias(c) for c in ids])


@register(oracle.core_until("resolved", "SELECT * EXCLUDE (CONTRATANTE, F_EMISION_POLIZA, "
                            "F_EMISION_CERT, F_INI_POLIZA, F_FIN_POLIZA) FROM resolved"))
def doc_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).drop(
        "CONTRATANTE", "F_EMISION_POLIZA", "F_EMISION_CERT", "F_INI_POLIZA", "F_FIN_POLIZA")


@register(oracle.core_until("good", "SELECT POLIZA, TIPO_DOC, NRO_DOCUMENTO, F_INI_COBER, "
                            "F_FIN_COBERT FROM good"))
def core_quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    return quality_filter(_resolved(spark, sf)).select(
        "POLIZA", "TIPO_DOC", "NRO_DOCUMENTO", "F_INI_COBER", "F_FIN_COBERT")


@register(oracle.with_ctes(("t", oracle.DATE_TEXTS),
                           final=f"SELECT k, TEXTO, {oracle.date_of('TEXTO')} FECHA FROM t"))
def parse_dates_lenient(spark: SparkSession, sf: str) -> DataFrame:
    df = inputs.date_texts(spark, sf).withColumn("FECHA", F.col("TEXTO"))
    return with_parsed_dates(df, ["FECHA"])


@register("""SELECT o_orderkey, cast(o_orderdate AS date) FECHA FROM orders""")
def parse_dates_strict(spark: SparkSession, sf: str) -> DataFrame:
    text = F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", parse_date_strict(text).alias("FECHA"))


@register(oracle.core_until("dated", "SELECT POLIZA, NRO_DOCUMENTO, F_INI_COBER, F_FIN_COBERT, "
                            "F_ANULACION_CERT FROM dated"))
def core_dates_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).select(
        "POLIZA", "NRO_DOCUMENTO", "F_INI_COBER", "F_FIN_COBERT", "F_ANULACION_CERT")


@register(oracle.core_until("placed", "SELECT POLIZA, F_INI_COBER, F_FIN_COBERT FROM placed"))
def placeholder_dates(spark: SparkSession, sf: str) -> DataFrame:
    return clear_placeholder_ends(_dated(spark, sf)).select(
        "POLIZA", "F_INI_COBER", "F_FIN_COBERT")


_RANGE_COLUMNS = ["POLIZA", "F_INI_COBER", "F_FIN_COBERT", "F_ANULACION_CERT"]


@register(oracle.core_until("in_range", f"SELECT {', '.join(_RANGE_COLUMNS)} FROM in_range"), name="date_range_filter")
def date_range_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return _in_range(spark, sf).select(*_RANGE_COLUMNS)


@register(oracle.core_until("bounded", "SELECT POLIZA, F_INI_COBER, F_FIN_COBERT, first_day, "
                            "last_day FROM bounded"), name="coverage_bounds")
def coverage_bound_dates(spark: SparkSession, sf: str) -> DataFrame:
    df = add_coverage_bounds(_in_range(spark, sf))
    return df.select("POLIZA", "F_INI_COBER", "F_FIN_COBERT",
                     F.col("_FIRST").alias("first_day"), F.col("_LAST").alias("last_day"))


@register(oracle.core_until("expanded", "SELECT POLIZA, F_INI_COBER, F_FIN_COBERT, F_OCURRENCIA "
                            "FROM expanded"))
def month_expand(spark: SparkSession, sf: str) -> DataFrame:
    return expand_months(add_coverage_bounds(_in_range(spark, sf))).select(
        "POLIZA", "F_INI_COBER", "F_FIN_COBERT", "F_OCURRENCIA")


# --- claims, union, reports ----------------------------------------------

def _claims_with_copies(spark: SparkSession, sf: str) -> DataFrame:
    df = with_claim_constants(clean_claims(inputs.claims_raw(spark, sf)), RUN_DATE)
    return expand_months(add_coverage_bounds(df)).select(*S.CONSOLIDATED_COLUMNS)


@register(oracle.claims_until("claims_clean", "SELECT * FROM claims_clean"))
def claims_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_claims(inputs.claims_raw(spark, sf))


@register(oracle.claims_until("claims_all", "SELECT DISTINCT * FROM claims_all"))
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_rows(_claims_with_copies(spark, sf))


def _written_claims(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned claims from a table: duplicates are looked for in several passes over them."""
    path = f"{scratch_folder(spark)}/claims"
    clean_claims(inputs.claims_raw(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


@register(oracle.claims_until("claims_clean", """SELECT * FROM (SELECT *, count(*) OVER (
  PARTITION BY NRO_DOCUMENTO, COD_RAMO, POLIZA, CERTIFICADO, ASEGURADO, F_INI_COBER) COPIES
  FROM claims_clean) WHERE COPIES > 1"""), name="duplicate_members")
def duplicated_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Claims that are reported more than once, each time they are."""
    return duplicate_members(_written_claims(spark, sf))


@register(oracle.claims_until("claims_clean", """SELECT * FROM (SELECT *, count(*) OVER (
  PARTITION BY NRO_DOCUMENTO, POLIZA, CERTIFICADO) COPIES FROM claims_clean)
  WHERE COPIES > 1"""))
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Claims that share document, policy and certificate with another one."""
    return duplicate_members(_written_claims(spark, sf),
                             ["NRO_DOCUMENTO", "POLIZA", "CERTIFICADO"])


@register(oracle.claims_until("claims_clean", """SELECT * FROM claims_clean QUALIFY
  row_number() OVER (PARTITION BY NRO_DOCUMENTO, ASEGURADO, POLIZA ORDER BY
    NRO_DOCUMENTO, COD_RAMO, POLIZA, CERTIFICADO, ASEGURADO, F_INI_COBER) = 1"""))
def unique_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The first claim of each document, person and policy."""
    df = clean_claims(inputs.claims_raw(spark, sf)).select(
        "NRO_DOCUMENTO", "COD_RAMO", "POLIZA", "CERTIFICADO", "ASEGURADO", "F_INI_COBER")
    return one_of_each(df, ["NRO_DOCUMENTO", "ASEGURADO", "POLIZA"])


@register(oracle.both(oracle.BOTH), name="union_bases")
def union_of_bases(spark: SparkSession, sf: str) -> DataFrame:
    return union_bases(core_consolidate(spark, sf), claims_consolidate(spark, sf))


_REPROCESSED = ("*, CASE WHEN regexp_full_match(right(NRO_DOCUMENTO, 1), '[0-9]') "
                "THEN cast(right(NRO_DOCUMENTO, 1) AS tinyint) END ULT_DIGI_DOC")


@register(oracle.both(f"SELECT {_REPROCESSED} FROM ({oracle.BOTH})"))
def reprocess_last_digit(spark: SparkSession, sf: str) -> DataFrame:
    return add_last_digit(union_of_bases(spark, sf))


def _reports(spark: SparkSession, sf: str) -> str:
    """Folder with the report of each base."""
    folder = f"{scratch_folder(spark)}/consolidated"
    write_report(core_consolidate(spark, sf), f"{folder}/core.parquet")
    write_report(claims_consolidate(spark, sf), f"{folder}/claims.parquet")
    return folder


@register(oracle.both(f"SELECT {_REPROCESSED} FROM ({oracle.BOTH})"))
def reprocessed_reports(spark: SparkSession, sf: str) -> DataFrame:
    folder = _reports(spark, sf)
    layers.reprocess_reports(spark, folder, f"{folder}_reprocessed")
    return spark.read.parquet(*report_paths(spark, f"{folder}_reprocessed"))


@register(oracle.both(f"SELECT *, true IN_ORDER FROM ({oracle.BOTH})"))
def ordered_consolidate(spark: SparkSession, sf: str) -> DataFrame:
    """The sorted report; each row with whether it follows the row before it."""
    folder = _reports(spark, sf)
    layers.sort_reports(spark, folder, f"{folder}_sorted")
    df = spark.read.parquet(*report_paths(spark, f"{folder}_sorted"))
    return with_order(spark, df).select(*S.CONSOLIDATED_COLUMNS, "IN_ORDER")


@register(oracle.both(f"""SELECT * FROM ({oracle.BOTH}) WHERE NRO_DOCUMENTO IN (
  SELECT NRO_DOCUMENTO FROM ({oracle.BOTH}) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 20)"""))
def document_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """All months of the 20 documents that have most of them, from the sorted report."""
    folder = _reports(spark, sf)
    layers.sort_reports(spark, folder, f"{folder}_sorted", lookup=True)
    (path,) = report_paths(spark, f"{folder}_sorted")
    top = (spark.read.parquet(path).groupBy("NRO_DOCUMENTO").count()
           .orderBy(F.desc("count"), "NRO_DOCUMENTO").limit(20))
    return find_documents(spark, path, [r.NRO_DOCUMENTO for r in top.collect()])


@register(oracle.core_until("core", """SELECT * EXCLUDE (PARENTESCO, FI) FROM core"""))
def export_ap(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/ap.parquet"
    write_report(core_consolidate(spark, sf), path, drop_optional=True)
    return spark.read.parquet(path)


@register(oracle.both("""SELECT BASE, count(*) WRITTEN, count(*) FOUND, count(*) COMPUTED
  FROM (SELECT BASE FROM core UNION ALL SELECT BASE FROM claims) GROUP BY BASE"""))
def row_count_check(spark: SparkSession, sf: str) -> DataFrame:
    """Rows counted while writing, found in the files, and computed anew."""
    folder = scratch_folder(spark)
    parts = []
    for name, query in (("core", core_consolidate), ("claims", claims_consolidate)):
        df = query(spark, sf)
        path = f"{folder}/{name}.parquet"
        written = write_report(df, path)
        found = spark.read.parquet(path).groupBy("BASE").agg(F.count(F.lit(1)).alias("FOUND"))
        computed = df.groupBy("BASE").agg(F.count(F.lit(1)).alias("COMPUTED"))
        parts.append(found.join(computed, "BASE").withColumn("WRITTEN", F.lit(written).cast("bigint")))
    return parts[0].unionByName(parts[1])


@register(oracle.both("""SELECT 'core' REPORT, true IS_OK, count(*) N FROM core
  UNION ALL SELECT 'claims', true, count(*) FROM claims
  UNION ALL SELECT 'reprocessed', false, count(*) FROM claims
  UNION ALL SELECT 'without_optional', false, count(*) FROM claims"""))
def parquet_width_check(spark: SparkSession, sf: str) -> DataFrame:
    folder = _reports(spark, sf)
    claims = read_consolidated(spark, folder).where(F.col("BASE") == S.BASE_CLAIMS)
    write_report(add_last_digit(claims), f"{folder}/reprocessed.parquet")
    write_report(claims, f"{folder}/without_optional.parquet", drop_optional=True)
    parts = []
    for path in report_paths(spark, folder):
        name = path.rsplit("/", 1)[-1].removesuffix(".parquet")
        try:
            df, is_ok = check_report(spark, path, S.CONSOLIDATED_COLUMNS), True
        except ValueError:
            df, is_ok = spark.read.parquet(path), False
        parts.append(df.agg(F.count(F.lit(1)).alias("N")).select(
            F.lit(name).alias("REPORT"), F.lit(is_ok).alias("IS_OK"), "N"))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


_PUBLISHED = [("old", 0), ("failed", 0), ("not committed", 0), ("cut commit", 0),
              ("concurrent", 1), ("loser tried again", 2), ("new", 3)]


@register(" UNION ALL ".join(
    f"""SELECT '{stage}' STAGE, count(*) N, cast(sum(o_orderkey) AS bigint) KEYS
    FROM orders WHERE o_orderkey % 4 = {part}""" for stage, part in _PUBLISHED))
def publish_replaces(spark: SparkSession, sf: str) -> DataFrame:
    """What a reader of a table sees after each thing that can happen to its writers."""
    path = f"{scratch_folder(spark)}/table.parquet"
    orders = inputs.table(spark, sf, "orders").select("o_orderkey")
    parts = [orders.where(F.col("o_orderkey") % 4 == i) for i in range(4)]
    seen = []

    def look(stage: str) -> None:
        seen.append(spark.read.parquet(published(spark, path)).agg(
            F.count(F.lit(1)).alias("N"), F.sum("o_orderkey").cast("bigint").alias("KEYS"))
            .select(F.lit(stage).alias("STAGE"), "N", "KEYS"))

    write_report(parts[0], path, by_log=True)
    look("old")
    fails = F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("boom"))).cast("bigint")
    try:
        write_report(parts[3].select(fails.alias("o_orderkey")), path, by_log=True)
    except Exception as error:
        if "boom" not in str(error):
            raise
    look("failed")
    first, second = new_version(path), new_version(path)
    parts[1].write.parquet(first)
    parts[2].write.parquet(second)
    look("not committed")
    start = last_commit(spark, path)
    write_text(spark, f"{path}/_commits/{start + 1:020}.json", '{"number": ')
    look("cut commit")
    commit_version(spark, path, first, parts[1].count(), start)
    try:
        commit_version(spark, path, second, parts[2].count(), start)
    except CommitConflict:
        look("concurrent")
    replace_if_unchanged(parts[2], path, last_commit(spark, path))
    look("loser tried again")
    write_report(parts[3], path, by_log=True)
    look("new")
    return reduce(DataFrame.unionAll, seen)


# --- source files --------------------------------------------------------

def _raw_columns(df: DataFrame) -> DataFrame:
    return df.select(*S.CORE_COLUMNS)


@register(oracle.CORE_RAW)
def csv_core_read(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_folder(spark)
    write_core_folders(inputs.core_raw(spark, sf), root, [{}, {}])
    return _raw_columns(read_core(spark, root))


@register(oracle.CORE_RAW)
def csv_delimiter_sniff(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_folder(spark)
    options = [{"sep": d} for d in S.CSV_DELIMITERS]
    write_core_folders(inputs.core_raw(spark, sf), root, options)
    return _raw_columns(read_core(spark, root))


@register(f"SELECT * REPLACE ('MUÑOZ é '||ID AS CONTRATANTE) FROM ({oracle.CORE_RAW})")
def csv_encoding_repair(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_folder(spark)
    df = inputs.core_raw(spark, sf).withColumn(
        "CONTRATANTE", F.concat(F.lit("MUÑOZ é "), F.col("ID")))
    write_core_folders(df, root, [{}, {"encoding": "ISO-8859-1"}])
    return _raw_columns(read_core(spark, root))


@register(f"""SELECT * REPLACE ('EMPRESA, '||ID AS CONTRATANTE, 'O'||chr(39)||'HARA '||ID AS ASEGURADO)
  FROM ({oracle.CORE_RAW})""")
def csv_line_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in outer quotes: a doubly quoted field and a stray quote in another."""
    def field(name: str) -> Column:
        if name == "CONTRATANTE":
            return F.concat(F.lit('""EMPRESA, '), F.col("ID"), F.lit('""'))
        if name == "ASEGURADO":
            return F.concat(F.lit('O"HARA '), F.col("ID"))
        return F.coalesce(F.col(name), F.lit(""))

    root = scratch_folder(spark)
    line = F.concat(F.lit('"'), F.concat_ws(",", *[field(c) for c in S.CORE_COLUMNS]), F.lit('"'))
    header = '"' + ",".join(S.CORE_COLUMNS) + '"'
    for i, part in enumerate(in_parts(inputs.core_raw(spark, sf), 2)):
        write_lines(part, line, header, f"{root}/carpeta {i}")
    return _raw_columns(read_core(spark, root))


@register(f"""SELECT * REPLACE (CONTRATANTE||chr(10)||'"'||ID||'", x' AS CONTRATANTE)
  FROM ({oracle.CORE_RAW})""")
def csv_quoted_newlines(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that hold a line break, quotes and a delimiter."""
    root = scratch_folder(spark)
    df = inputs.core_raw(spark, sf).withColumn(
        "CONTRATANTE", F.concat("CONTRATANTE", F.lit('\n"'), F.col("ID"), F.lit('", x')))
    write_core_folders(df, root, [{}, {"sep": ";"}])
    return _raw_columns(read_core(spark, root, quoted_newlines=True))


@register(oracle.CORE_RAW)
def csv_quote_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every field in quotes, for each delimiter."""
    root = scratch_folder(spark)
    options = [{"sep": d, "quoteAll": True, "emptyValue": ""} for d in S.CSV_DELIMITERS]
    write_core_folders(inputs.core_raw(spark, sf), root, options)
    return _raw_columns(read_core(spark, root))


def _plain_line(names: dict[str, Column]) -> Column:
    return F.concat_ws(",", *[
        names.get(c, F.coalesce(F.col(c), F.lit(""))) for c in S.CORE_COLUMNS])


@register(f"""SELECT * REPLACE (CASE WHEN cast(ID AS bigint) // 2 % 3 = 0 THEN 'O'||chr(39)||'HARA '||ID
  ELSE 'O"HARA '||ID END AS ASEGURADO) FROM ({oracle.CORE_RAW})""")
def csv_mixed_wrapped(spark: SparkSession, sf: str) -> DataFrame:
    """Files in which one line in three stands in outer quotes."""
    root = scratch_folder(spark)
    line = _plain_line({"ASEGURADO": F.concat(F.lit('O"HARA '), F.col("ID"))})
    wrapped = F.concat(F.lit('"'), line, F.lit('"'))
    is_wrapped = F.floor(F.col("ID").cast("bigint") / 2) % 3 == 0
    line = F.when(is_wrapped, wrapped).otherwise(line)
    for i, part in enumerate(in_parts(inputs.core_raw(spark, sf), 2)):
        write_lines(part, line, ",".join(S.CORE_COLUMNS), f"{root}/carpeta {i}")
    return _raw_columns(read_core(spark, root))


@register(f"""SELECT ID, POLIZA, 'x' AS ASEGURADO FROM ({oracle.CORE_RAW})""")
def csv_stray_quote(spark: SparkSession, sf: str) -> DataFrame:
    """A quote that is opened and never closed stays inside its line: no row is lost."""
    root = scratch_folder(spark)
    is_open = F.col("ID").cast("bigint") % 7 == 0
    name = F.when(is_open, F.lit('"x')).otherwise(F.lit("x"))
    line = _plain_line({"ASEGURADO": name})
    for i, part in enumerate(in_parts(inputs.core_raw(spark, sf), 2)):
        write_lines(part, line, ",".join(S.CORE_COLUMNS), f"{root}/carpeta {i}")
    found = read_core(spark, root)
    return found.select("ID", "POLIZA", F.regexp_replace("ASEGURADO", "^'", "").alias("ASEGURADO"))


@register(f"""SELECT * REPLACE (CASE WHEN cast(ID AS bigint) % 2 = 1 THEN PARENTESCO END AS PARENTESCO,
  CASE WHEN cast(ID AS bigint) % 2 = 1 THEN FI END AS FI) FROM ({oracle.CORE_RAW})""")
def csv_core_18(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_folder(spark)
    narrow, full = in_parts(inputs.core_raw(spark, sf), 2)
    write_csv(narrow.drop(*S.CORE_OPTIONAL_COLUMNS), f"{root}/carpeta 0")
    write_csv(full, f"{root}/carpeta 1")
    return _raw_columns(read_core(spark, root))


_AUDITED = [("carpeta_0", ",", 20, 0), ("carpeta_1", ";", 20, 1), ("carpeta_2", "|", 18, 2)]


@register(" UNION ALL ".join(
    f"""SELECT '{folder}' FOLDER, '{d}' DELIMITER, {width} WIDTH,
    {str(part != 1).lower()} IS_UTF8, count(*) N, cast(0 AS bigint) QUOTED_LINES
    FROM orders WHERE o_orderkey % 3 = {part}""" for folder, d, width, part in _AUDITED))
def csv_header_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Layout of the files by folder, from their header lines."""
    root = scratch_folder(spark)
    df = inputs.core_raw(spark, sf).withColumn("CONTRATANTE", F.lit("PEÑA"))
    for part, (folder, d, width, number) in zip(in_parts(df, 3), _AUDITED, strict=True):
        encoding = "ISO-8859-1" if number == 1 else "UTF-8"
        columns = S.CORE_COLUMNS[:width]
        write_csv(part.select(*columns), f"{root}/{folder}", sep=d, encoding=encoding)
    audit = audit_csv_files(spark, [core_pattern(root)])
    return audit.groupBy("FOLDER", "DELIMITER", "WIDTH", "IS_UTF8").agg(
        F.sum(F.col("LINES") - 1).alias("N"), F.sum("QUOTED_LINES").alias("QUOTED_LINES"))


@register(f"SELECT *, true HAS_FILE, true HAS_LOAD_TIME FROM ({oracle.CORE_RAW})")
def bronze_core(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_folder(spark)
    write_core_folders(inputs.core_raw(spark, sf), f"{root}/source", [{}, {"sep": "|"}])
    layers.ingest_core(spark, f"{root}/source", f"{root}/lake")
    df = load_layer(spark, f"{root}/lake", layers.BRONZE, layers.CORE)
    return _with_lineage_flags(df, S.CORE_COLUMNS, "%.csv")


def _no_day_first(column: str) -> str:
    text = f"substr({column}, 1, 10)"
    return (f"({column} IS NOT NULL AND NOT coalesce(regexp_full_match({text}, "
            f"'[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') AND try_strptime({text}, '%d/%m/%Y') "
            "IS NOT NULL, false))")


@register(oracle.core_until("good", f"""SELECT *, sum(1) OVER ()::bigint ALL_POLICIES,
  (sum(FAULTS & 1) OVER ())::bigint ALL_CANCELLED, (sum((FAULTS >> 1) & 1) OVER ())::bigint ALL_STARTS,
  (sum((FAULTS >> 2) & 1) OVER ())::bigint ALL_ENDS, true FOUND
  FROM (SELECT POLIZA, F_ANULACION_CERT, F_INI_COBER, F_FIN_COBERT, cast(
    {_no_day_first('F_ANULACION_CERT')}::int + 2 * {_no_day_first('F_INI_COBER')}::int
    + 4 * {_no_day_first('F_FIN_COBERT')}::int AS int) FAULTS FROM good) WHERE FAULTS > 0"""))
def strict_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Policies that break strict dates, the totals the job reports, and whether each is
    found again in the bronze table by its file and row."""
    lake = f"{scratch_folder(spark)}/lake"
    raw = inputs.core_raw(spark, sf).withColumn("FILE", F.lit("orders"))
    save_layer(layers.with_load_time(raw), lake, layers.BRONZE, layers.CORE)
    options = layers.Options(date_mode="strict", keep_rejects=True)
    counts = dict.fromkeys(["policies", *S.CORE_DATE_COLUMNS], 0)
    try:
        layers.build_silver(spark, lake, layers.CORE, RUN_DATE, options)
    except layers.RejectedRows as error:
        counts = error.counts
    rejects = load_layer(spark, lake, layers.REJECTS, layers.CORE)
    bronze = load_layer(spark, lake, layers.BRONZE, layers.CORE).select(
        F.col("POLIZA").alias("RAW"), F.col("_metadata.file_name").alias("BRONZE_FILE"),
        F.col("_metadata.row_index").alias("BRONZE_ROW"))
    names = ["ALL_POLICIES", "ALL_CANCELLED", "ALL_STARTS", "ALL_ENDS"]
    return rejects.join(bronze, ["BRONZE_FILE", "BRONZE_ROW"], "left").select(
        "POLIZA", "F_ANULACION_CERT", "F_INI_COBER", "F_FIN_COBERT", "FAULTS",
        *[F.lit(n).cast("bigint").alias(a) for a, n in zip(names, counts.values())],
        F.col("POLIZA").eqNullSafe(F.col("RAW")).alias("FOUND"))


def _with_lineage_flags(df: DataFrame, columns: list[str], names: str) -> DataFrame:
    return df.select(*columns, F.col("FILE").like(names).alias("HAS_FILE"),
                     F.col("FECHA_CARGA").isNotNull().alias("HAS_LOAD_TIME"))


@register(f"SELECT *, true HAS_FILE, true HAS_LOAD_TIME FROM ({oracle.CLAIMS_RAW})")
def bronze_claims(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_folder(spark)
    write_claims_workbooks(inputs.claims_raw(spark, sf), f"{root}/source")
    layers.ingest_claims(spark, f"{root}/source", f"{root}/lake")
    df = layers.load_claims(spark, f"{root}/lake")
    return _with_lineage_flags(df, S.CLAIMS_COLUMNS, "%.xlsx")


@register(oracle.CLAIMS_RAW)
def xlsx_claims_read(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{scratch_folder(spark)}/source"
    write_claims_workbooks(inputs.claims_raw(spark, sf), folder)
    return claims_rows(read_workbooks(spark, folder)).drop("FILE")


_BOOKS = f"count(*) // {ROWS_PER_WORKBOOK} + 1"


@register(f"""SELECT 'Siniestros' SHEET, {_BOOKS} BOOKS, 0 SKIPPED, count(*) CLAIMS FROM ({oracle.CLAIMS_RAW})
  UNION ALL SELECT 'Notas', {_BOOKS}, {_BOOKS}, 0 FROM ({oracle.CLAIMS_RAW})
  UNION ALL SELECT 'Vacia', {_BOOKS}, {_BOOKS}, 0 FROM ({oracle.CLAIMS_RAW})""")
def xlsx_workbook_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Workbooks, skipped sheets and claims by sheet name."""
    folder = f"{scratch_folder(spark)}/source"
    write_claims_workbooks(inputs.claims_raw(spark, sf), folder)
    return read_workbooks(spark, folder).groupBy("SHEET").agg(
        F.count_distinct("FILE").alias("BOOKS"),
        F.count_if(F.col("ERROR").isNotNull()).alias("SKIPPED"),
        F.count_if(F.col("ERROR").isNull()).alias("CLAIMS"))


@register(f"""SELECT SHEET, ERROR, {_BOOKS} BOOKS FROM ({oracle.CLAIMS_RAW}) CROSS JOIN (VALUES
    ('Notas', 'sheet not readable: columns not found: [''DNI'', ''POLIZA'', ''CERTIFICADO'', ''ASEGURADO'', ''OCURRENCIA'']'),
    ('Vacia', 'sheet not readable: columns not found: [''DNI'', ''RAMO'', ''POLIZA'', ''CERTIFICADO'', ''ASEGURADO'', ''OCURRENCIA'']')
  ) reasons(SHEET, ERROR) GROUP BY SHEET, ERROR""")
def xlsx_skipped_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets that were skipped, why, and in how many workbooks."""
    folder = f"{scratch_folder(spark)}/source"
    write_claims_workbooks(inputs.claims_raw(spark, sf), folder)
    skipped = skipped_sheets(read_workbooks(spark, folder))
    return skipped.groupBy("SHEET", "ERROR").agg(F.count_distinct("FILE").alias("BOOKS"))


# A folder for each thing that a guard refuses, and what it says.
_GUARDED = [("good", "1.csv", "read", "accepted", 0), ("upper case", "2.CSV", "read", "accepted", 1),
            ("hidden", "_3.csv", "hidden", "start with _ or a dot", 2), ("dotted", ".4.csv", "hidden",
            "start with _ or a dot", 3), ("no byte", "5.csv", "empty", "empty CSV files", None),
            ("no rows", "6.csv", "read", "without data rows", None),
            ("narrow", "7.csv", "read", "without [18, 20] columns", 4),
            ("other", "8.txt", "other", "no CSV files", 5)]
ROWS_PER_DELIVERY = 100_000


@register(" UNION ALL ".join(
    f"""SELECT '{case}' SOURCE, '{file}' FILE, '{kind}' KIND, '{verdict}' VERDICT,
    count(*){'' if verdict == 'accepted' else ' * 0'} ROWS_READ, count(*) * 0 UNREAD
    FROM orders WHERE o_orderkey % 6 = {0 if part is None else part}"""
    for case, file, kind, verdict, part in _GUARDED))
def source_guards(spark: SparkSession, sf: str) -> DataFrame:
    """What the guard says of each source, the rows read of accepted ones, and files not read."""
    root = scratch_folder(spark)
    deliveries = spark.read.parquet(f"{sf}/orders.parquet").count() // 6 // ROWS_PER_DELIVERY + 1
    found = []
    for case, file, _, _, part in _GUARDED:
        if part is None:
            text = ",".join(S.CORE_COLUMNS) + "\n" if case == "no rows" else ""
            write_text(spark, f"{root}/{case}/delivery 0/{file}", text)
        else:
            columns = S.CORE_COLUMNS[:19] if case == "narrow" else S.CORE_COLUMNS
            rows = inputs.core_raw(spark, sf, part=(6, part)).select(*columns)
            write_deliveries(rows, f"{root}/{case}", file, deliveries)
        files = core_files(spark, f"{root}/{case}")
        verdict, rows, unread = "accepted", F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        try:
            require_core_files(files, root)
            read_core(spark, f"{root}/{case}").groupBy("FOLDER", "FILE").count().write.parquet(
                f"{root}-read/{case}")
            read = spark.read.parquet(f"{root}-read/{case}")
            rows = F.lit(read.agg(F.sum("count")).first()[0])
            unread = F.lit(unread_files(files, read).count())
        except (ValueError, FileNotFoundError) as error:
            verdict = next(v for _, _, _, v, _ in _GUARDED if v in str(error))
        files = files.where(F.col("KIND") != MARK)
        found.append(files.select(F.lit(case).alias("SOURCE"), "FILE", "KIND",
                                  F.lit(verdict).alias("VERDICT"),
                                  rows.cast("bigint").alias("ROWS_READ"),
                                  unread.cast("bigint").alias("UNREAD")).distinct())
    return reduce(DataFrame.unionAll, found)


_BOOK_NAMES = [("uno.xlsx", "accepted"), ("DOS.XLSX", "accepted"), ("_b.xlsx", "start with _ or a dot"),
               (".c.xlsx", "start with _ or a dot"), ("notas.txt", "no workbooks")]


@register(" UNION ALL ".join(
    f"""SELECT '{name}' FILE, '{verdict}' VERDICT, count(*){'' if verdict == 'accepted' else
    ' * 0'} CLAIMS FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_orderkey % 5 = {part}""" for part, (name, verdict) in enumerate(_BOOK_NAMES)))
def workbook_guards(spark: SparkSession, sf: str) -> DataFrame:
    """What the guard says of workbooks by their names, and the claims read of accepted ones."""
    root = scratch_folder(spark)
    found = []
    for part, (name, _) in enumerate(_BOOK_NAMES):
        claims = inputs.claims_raw(spark, sf, part=(5, part))
        folder = f"{root}/{part}"
        write_named_workbooks(claims, folder, name)
        files = workbook_files(spark, folder, depth=1)
        verdict, count = "accepted", 0
        try:
            require_workbooks(files, folder)
            count = claims_rows(read_workbooks(spark, folder, depth=1)).count()
        except (ValueError, FileNotFoundError) as error:
            verdict = next(v for _, v in _BOOK_NAMES if v in str(error))
        # A workbook of this name in each delivery.
        found.append(files.select("FILE", F.lit(verdict).alias("VERDICT"),
                                  F.lit(count).cast("bigint").alias("CLAIMS")).distinct())
    return reduce(DataFrame.unionAll, found)


def _source_folders(spark: SparkSession, sf: str, root: str) -> layers.Paths:
    options = [{}, {"sep": ";"}]
    parts = [inputs.core_raw(spark, sf, part=(len(options), i)) for i in range(len(options))]
    write_core_folders(parts, f"{root}/core", options)
    write_claims_workbooks(inputs.claims_raw(spark, sf), f"{root}/claims")
    return layers.Paths(f"{root}/core", f"{root}/claims", f"{root}/lake", f"{root}/reports")


@register(oracle.both(oracle.BOTH))
def layered_run(spark: SparkSession, sf: str) -> DataFrame:
    """Files to bronze, silver and gold reports."""
    paths = _source_folders(spark, sf, scratch_folder(spark))
    layers.run_layers(spark, paths, run_date=RUN_DATE)
    return spark.read.parquet(*report_paths(spark, paths.reports))


# Layers and sources of a run, on an empty lake, one after the other; what each one makes.
_RUNS = [(("silver", "gold"), ("core", "claims"), ()), (("bronze",), ("core",), ("bronze core",)),
         (("silver",), ("core", "claims"), ("silver core",)),
         (("gold",), ("core",), ("gold core",)),
         (("bronze", "silver"), ("claims",), ("bronze claims", "silver claims")),
         (("gold",), ("claims", "core"), ("gold claims", "gold core"))]
_MADE = {"bronze core": f"SELECT count(*) FROM ({oracle.CORE_RAW})",
         "bronze claims": f"SELECT count(*) FROM ({oracle.CLAIMS_RAW})",
         **{f"{layer} {source}": f"SELECT count(*) FROM {source}" for layer in ("silver", "gold")
            for source in ("core", "claims")}}


@register(oracle.both(" UNION ALL ".join(
    f"""SELECT {number} RUN, '{made.split()[0]}' LAYER, '{made.split()[1]}' SOURCE, ({_MADE[made]}) N"""
    for number, (_, _, result) in enumerate(_RUNS) for made in result)))
def run_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that runs of chosen layers and sources make; what an earlier layer lacks is skipped."""
    paths = _source_folders(spark, sf, scratch_folder(spark))
    rows = []
    for number, (chosen, sources, _) in enumerate(_RUNS):
        made = layers.run_layers(spark, paths, chosen, sources, RUN_DATE)
        rows += [(number, layer, source, count) for (layer, source), count in made.items()]
    return spark.createDataFrame(rows, "RUN int, LAYER string, SOURCE string, N bigint")
