"""Whether the rows of a report follow each other, without moving the rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verification.files import scratch_folder

_KEY = ["NRO_DOCUMENTO", "F_OCURRENCIA"]
_SEAMS = "file string, place bigint, kind string, NRO_DOCUMENTO string, F_OCURRENCIA date"


def _less(a: pa.Array, b: pa.Array) -> pa.Array:
    """a < b, missing values last."""
    return pc.or_(pc.fill_null(pc.less(a, b), False), pc.and_(pc.is_valid(a), pc.is_null(b)))


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))


def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come before the one they follow, and the first and last of each run of rows
    that follow each other within a batch."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        before, after = batch.slice(0, rows - 1), batch.slice(1)
        follows = pc.and_(pc.equal(before["file"], after["file"]),
                          pc.equal(pc.add(before["place"], 1), after["place"]))
        (a, month_a), (b, month_b) = [[x[c] for c in _KEY] for x in (before, after)]
        bad = pc.or_(_less(b, a), pc.and_(_same(a, b), _less(month_b, month_a)))
        cut, edge = pc.invert(follows), pa.array([True])
        for kind, chosen in (("bad", pa.concat_arrays([pa.array([False]), pc.and_(follows, bad)])),
                             ("start", pa.concat_arrays([edge, cut])),
                             ("end", pa.concat_arrays([cut, edge]))):
            found = batch.filter(chosen)
            kinds = pa.repeat(pa.scalar(kind), found.num_rows)
            yield pa.RecordBatch.from_arrays(
                [found["file"], found["place"], kinds, *[found[c] for c in _KEY]],
                ["file", "place", "kind", *_KEY])


def _key() -> Column:
    # Missing values come last.
    return F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")).alias(c)
                      for c in _KEY])


def with_order(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Add IN_ORDER: whether a row of a Parquet report follows the row before it in its file,
    and the file the one before it.

    Rows come from a file in its order, so they are compared where they are read; only the
    ends of batches, and rows that are out of order, are joined.
    """
    folder = scratch_folder(spark)
    keyed = df.select("*", F.col("_metadata.file_name").alias("file"),
                      F.col("_metadata.row_index").alias("place"))
    narrow = keyed.select("file", "place", *_KEY)
    narrow.mapInArrow(_seams, _SEAMS).write.parquet(f"{folder}/seams")
    seams = spark.read.parquet(f"{folder}/seams")
    ends = seams.where("kind = 'end'").select(
        "file", (F.col("place") + 1).alias("place"), _key().alias("before"))
    late = (seams.where("kind = 'start'").select("file", "place", _key().alias("k"))
            .join(ends, ["file", "place"]).where("k < before").select("file", "place"))
    files = narrow.select("file", _key().alias("k")).groupBy("file").agg(
        F.min("k").alias("first"), F.max("k").alias("last"))
    # A row per file of the report.
    lag = F.lag("last").over(Window.orderBy("file"))
    files = files.select("file", (F.col("first") >= F.coalesce(lag, F.col("first"))).alias("ok"))
    seams.where("kind = 'bad'").select("file", "place").unionByName(late).write.parquet(
        f"{folder}/late")
    files.where("NOT ok").select("file").write.parquet(f"{folder}/late_files")
    # Both are empty as a rule; their sizes are known, as they are written.
    late = spark.read.parquet(f"{folder}/late").withColumn("late", F.lit(True))
    late_files = spark.read.parquet(f"{folder}/late_files").withColumn("late_file", F.lit(True))
    in_order = F.col("late").isNull() & F.col("late_file").isNull()
    return (keyed.join(late, ["file", "place"], "left").join(late_files, "file", "left")
            .withColumn("IN_ORDER", in_order))
