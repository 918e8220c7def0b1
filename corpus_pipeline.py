"""Stages from raw documents to packed training sequences.

Each stage is one operator, with its decisions applied to the documents; all but the last
return documents with the columns they came with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth.llm import langid
from covermonth.llm.decontaminate import clean_documents
from covermonth.llm.minhash import near_duplicates
from covermonth.llm.packing import pack
from covermonth.llm.queries import table, tokenizer_path
from covermonth.llm.scratch import Scratch
from covermonth.llm.secrets import mask_secrets

LEAST_SHARE = 0.5  # of a document's words in its main language


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose words are mostly of one known language.

    The model is trained on the documents that state a language. Documents without
    letters go; without any stated language all others stay.
    """
    model = langid.train(docs.select("text", "lang"))
    found = langid.predict(F.col("text"), model, spark)
    kept = (found["score"] >= LEAST_SHARE) if model.languages else F.col("text").rlike(r"\p{L}")
    return docs.where(kept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id, rows without one last.

    Rows are told apart by their own numbers, so rows that share a doc_id but not their text
    all stay, and rows without doc_id are compared like others.
    """
    scratch = Scratch(spark, "near-rows")
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = f"c{docs.columns.index('text')}"
    # Numbers of rows are fixed once they are written.
    rows = scratch.save(docs.select(F.monotonically_increasing_id().alias("row"), *columns), "rows")
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col(text).alias("text")))
    order = F.struct(*([F.col("c_id").isNull().alias("none"), "c_id"]), "row")
    ids = rows.select("row", F.col(f"c{docs.columns.index('doc_id')}").alias("c_id"))
    kept = (found.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row")
            .groupBy("component_id").agg(F.min(order)["row"].alias("row")).select("row"))
    return rows.join(kept, "row", "left_semi").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark passages."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return mask_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", hide_secrets),
    ("packing", pack_sequences),
]

# Language likelihoods, signatures and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each reads what the one before wrote."""
    scratch = Scratch(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
