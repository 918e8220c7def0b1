"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth.llm import oracle
from covermonth.llm.brown import score
from covermonth.llm.codes import encode
from covermonth.llm.decontaminate import contamination
from covermonth.llm.html_text import main_text
from covermonth.llm.langid import predict, train
from covermonth.llm.minhash import near_duplicates
from covermonth.llm.negatives import hard_negatives
from covermonth.llm.packing import pack
from covermonth.llm.quality import BASE_POLICY, apply_policy, ledger
from covermonth.llm.redirects import Rule, judge
from covermonth.llm.secrets import find_secrets
from covermonth.llm.sharding import kd_shards
from covermonth.llm.warc import round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 3, Fraction(85, 100))


QUALITY_POLICY = "prose-2"


def op2_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")), BASE_POLICY, "base_kept")
    rows = apply_policy(rows, QUALITY_POLICY)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("base_kept")).alias("base_failed"), "kept", "failed_bits")


def crc_of_id(modulus: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id(4) == 2, F.lit(False))
    model = train(docs.where(~held_out).select("text", "lang"))
    found = docs.select("doc_id", held_out.alias("held_out"),
                        predict(F.col("text"), model, spark).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"),
                        F.col("p.score").alias("score"), F.col("p.mixture").alias("mixture"))


def op4_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_of_id(10) == 0, F.lit(False))
    return score(table(spark, sf_dir, "documents"), held_out)


def op5_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select(
        "page_id", "url", main_text(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_exact_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "documents").select(
        F.col("doc_id"), find_secrets(F.col("text")).alias("spans"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return spans.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("guess").alias("n_guess"))


def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0,
                          positives=5, negatives=3, low=Fraction(50, 100), high=Fraction(95, 100))


URL_RULES = [
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def op13_redirect_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bbit_minhash": op1_bbit_minhash,
    "op2_rule_ledger": op2_rule_ledger,
    "op3_language_mixture": op3_language_mixture,
    "op4_brown_classes": op4_brown_classes,
    "op5_html_blocks": op5_html_blocks,
    "op6_exact_complement": op6_exact_complement,
    "op7_warc": op7_warc,
    "op8_guess_cost": op8_guess_cost,
    "op9_spaced_seeds": op9_spaced_seeds,
    "op10_kd_sharding": op10_kd_sharding,
    "op11_ball_kmeans": op11_ball_kmeans,
    "op12_angular_negatives": op12_angular_negatives,
    "op13_redirect_classes": op13_redirect_classes,
}

# Five hexadecimal digits of the checksum are four characters of its base32 form.
ORACLE: dict[str, str] = {
    "op1_bbit_minhash": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1),
                                    lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g
            FROM d
        ), n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id
        ), c AS (
            SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ), l AS (
            SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * k >= 85 * (x.n + y.n - k)
        ), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l
        ), r AS (
            SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
        ), m AS (SELECT a, MIN(b) AS b FROM r GROUP BY a)
        SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles,
            LEAST(d.doc_id, COALESCE(m.b, d.doc_id)) AS component_id,
            d.doc_id <= COALESCE(m.b, d.doc_id) AS kept
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
    """,
    "op2_rule_ledger": r"""
        WITH d AS (
            SELECT doc_id, COALESCE(text, '') AS t,
                regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), u AS (
            SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM d
        ), g AS (
            SELECT doc_id, i, w AS a, LEAD(w) OVER p AS b, LEAD(w, 2) OVER p AS c FROM u
            WINDOW p AS (PARTITION BY doc_id ORDER BY i)
        ), h AS (
            SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, a, b, c) AS k
            FROM g WHERE c IS NOT NULL
        ), v AS (
            SELECT doc_id, COUNT(DISTINCT i + o) AS n_repeat_words
            FROM h, range(0, 3) r(o) WHERE k > 1 GROUP BY doc_id
        ), top AS (
            SELECT doc_id, MAX(k) AS n_top_word, MAX(len) AS longest FROM (
                SELECT doc_id, COUNT(*) AS k, MAX(length(w)) AS len FROM u GROUP BY doc_id, w)
            GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, CAST(SUM(k) AS BIGINT) AS n_lines,
                CAST(SUM(k - 1) AS BIGINT) AS n_dup_lines FROM (
                SELECT doc_id, line, COUNT(*) AS k FROM (
                    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
                WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL)
            GROUP BY doc_id
        ), f AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                COALESCE(n_dup_lines, 0) AS n_dup_lines,
                COALESCE(n_repeat_words, 0) AS n_repeat_words,
                COALESCE(n_lines, 0) AS n_lines, COALESCE(n_top_word, 0) AS n_top_word,
                COALESCE(longest, 0) AS longest,
                len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
                length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS n_letters,
                length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper,
                length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims
            FROM d LEFT JOIN v USING (doc_id) LEFT JOIN top USING (doc_id)
                LEFT JOIN lines USING (doc_id)
        ), b AS (
            SELECT *, (n_words < 50)::BIGINT
                + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
                + 4 * (100 * n_symbols > 10 * n_words)::BIGINT
                + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
                + 16 * (100 * n_letter_words < 60 * n_words)::BIGINT
                + 32 * (10 * word_chars < 25 * n_words)::BIGINT
                + 64 * (word_chars > 12 * n_words)::BIGINT
                + 128 * (100 * n_top_word > 30 * n_words)::BIGINT
                + 256 * (100 * n_upper > 50 * n_letters)::BIGINT
                + 512 * (100 * n_exclaims > 20 * n_words)::BIGINT
                + 1024 * (longest > 1000)::BIGINT AS failed_bits
            FROM f
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
    """,
    "op7_warc": """
        WITH p AS (
            SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS h FROM pages
        ), d AS (
            SELECT page_id, h, octet_length(encode(html)) AS payload_bytes,
                array_to_string(list_transform(range(0, 8), lambda i: array_to_string(
                    list_transform(range(0, 4), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                        1 + (((CAST('0x' || substr(h, CAST(5 * i + 1 AS INT), 5) AS INT)
                            >> CAST(15 - 5 * j AS INT)) & 31)), 1)), '')), '') AS payload_digest
            FROM p
        ), o AS (SELECT h, MAX(page_id) AS original FROM d GROUP BY h)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> original THEN original END AS refers_to
        FROM d JOIN o USING (h)
    """,
    "op11_ball_kmeans": oracle.CODES,
    "op12_angular_negatives": oracle.NEGATIVES,
    "op13_redirect_classes": oracle.REDIRECTS,
}
