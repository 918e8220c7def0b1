"""Shards of near-equal bytes by a k-d tree over metadata.

Everything here is DataFrame functions. A point of the tree is a group of equal
texts, weighted with the bytes of all its copies, so that copies stay together. Only a
group that outweighs a whole shard is cut, into points of `grain` of a shard, by a hash of the
document id: one text that makes up a third of all rows is spread like any others.

Each level of the tree cuts all its nodes at once. The widest dimension of a node is
the one with the largest range, measured against the range of the whole table. The
weighted median along it is found by three passes of 4096 bins, each pass inside the
bin that holds the median: 20 bits of the value and 16 bits of a hash that breaks
ties. What is gathered is a histogram for each node, never the points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covermonth.llm.scratch import Scratch

VALUE_BITS = 20
TIE_BITS = 16
BIN_BITS = 12
PASSES = (VALUE_BITS + TIE_BITS) // BIN_BITS


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    numbers: Sequence[str] = ("doc_id",),
    categories: Sequence[str] = ("source", "lang"),
    grain: float = 0.02,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    Give the number of shards, or the bytes that a shard should have. Dimensions of
    the tree are the size of the text, `numbers` and `categories` (hashed); columns that the
    table lacks are left out, nulls count as one more value. Equal texts share a point and a shard,
    with the metadata of the smallest doc_id, unless they outweigh a shard: then they are spread.

    Null texts are one group of size 1 each and checksum 0. Repeated rows get a slot each. An
    empty table gives an empty result. Further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "kd-shards")
    points_of, docs_out = _points(docs, shards, target_bytes, numbers, categories, grain, scratch)
    if points_of is None:
        return docs_out
    points, names, total_shards = points_of
    for level in range((total_shards - 1).bit_length()):
        points = _split(points, names, level, scratch)
    leaves = points.select("g", "cell", F.col("first").alias("shard"))
    placed = docs_out.join(leaves, ["g", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard",
        F.pmod(F.xxhash64("doc_id"), F.lit(_buckets(docs))).cast("int").alias("bucket"),
    )
    return _slots(scratch.save(placed, "placed"))


def _buckets(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _points(docs, shards, target_bytes, numbers, categories, grain, scratch):
    numbers = [c for c in numbers if c in docs.columns]
    categories = [c for c in categories if c in docs.columns]
    size = text_bytes(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("hash"),
        F.log2(size.cast("double")).alias("v0"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"v{i}")
          for i, c in enumerate(numbers, 1)],
        *[F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(1 << VALUE_BITS)).cast("double")
          .alias(f"v{i}") for i, c in enumerate(categories, 1 + len(numbers))],
    )
    names = [f"v{i}" for i in range(1 + len(numbers) + len(categories))]
    rows = rows.withColumn("g", F.xxhash64("hash", "text_crc32", "size"))
    rows = scratch.save(rows, "rows")
    whole = rows.agg(
        F.sum("size").alias("bytes"),
        *[F.min(n).alias(f"lo_{n}") for n in names],
        *[F.max(n).alias(f"hi_{n}") for n in names],
    ).first()
    if whole["bytes"] is None:
        empty = rows.select("doc_id", "size", "text_crc32",
                            F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
        return None, empty
    if shards is None:
        shards = max(1, -(-whole["bytes"] // target_bytes))
    shard_bytes = whole["bytes"] / shards
    limit = max(1.0, grain * shard_bytes)

    # Fewer groups than shards can outweigh one.
    heavy = (rows.groupBy("g").agg(F.sum("size").alias("bytes"))
             .where(F.col("bytes") > shard_bytes)
             .select("g", F.ceil(F.col("bytes") / limit).alias("cells")))
    heavy = scratch.save(heavy, "heavy")
    cell = F.when(F.col("cells").isNotNull(),
                  F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("cells"))).otherwise(0)
    rows = rows.join(heavy, "g", "left").withColumn("cell", cell).drop("cells")

    first = rows.groupBy("g", "cell").agg(
        F.sum("size").alias("w"), F.min(F.struct("doc_id", *names)).alias("m"))
    tie = F.pmod(F.xxhash64("g", "cell", F.lit(11)), F.lit(1 << TIE_BITS))
    scaled = []
    for n in names:
        width = whole[f"hi_{n}"] - whole[f"lo_{n}"]
        unit = (F.col(f"m.{n}") - whole[f"lo_{n}"]) / width if width > 0 else F.lit(0.0)
        value = F.least(F.floor(unit * (1 << VALUE_BITS)), F.lit((1 << VALUE_BITS) - 1))
        scaled.append((value.cast("long") * (1 << TIE_BITS) + tie).alias(n))
    points = first.select("g", "cell", "w", *scaled,
                          F.lit(0).alias("first"), F.lit(int(shards)).alias("k"))
    points = scratch.save(points, "points")
    return (points, names, shards), rows.select("doc_id", "size", "text_crc32", "g", "cell")


def _split(points: DataFrame, names: list[str], level: int, scratch: Scratch) -> DataFrame:
    """Cut every node of this level that has several shards left."""
    open_points = points.where(F.col("k") > 1)
    widths = open_points.groupBy("first").agg(
        F.sum("w").alias("total"), F.first("k").alias("k"),
        *[(F.max(F.shiftright(n, TIE_BITS)) - F.min(F.shiftright(n, TIE_BITS))).alias(n)
          for n in names],
    )
    widest = F.array_max(F.array(*[F.struct(F.col(n).alias("width"), F.lit(-i).alias("order"))
                                   for i, n in enumerate(names)]))
    left = F.floor(F.col("k") / 2).cast("int")
    nodes = widths.select(
        "first", F.negate(widest["order"]).alias("dim"), left.alias("left"),
        (F.col("total") * left / F.col("k")).alias("goal"),
        F.lit(0).cast("long").alias("start"), F.lit(0.0).alias("before"),
    )
    nodes = scratch.save(nodes, f"nodes-{level}-0")
    along = F.element_at(F.array(*names), F.col("dim") + 1)
    for step in range(PASSES):
        shift = VALUE_BITS + TIE_BITS - BIN_BITS * (step + 1)
        place = F.shiftright(F.col("x") - F.col("start"), shift)
        inside = (open_points.join(nodes, "first").withColumn("x", along)
                  .withColumn("bin", place)
                  .where((F.col("x") >= F.col("start")) & (F.col("bin") < (1 << BIN_BITS))))
        bins = inside.groupBy("first", "bin").agg(F.sum("w").alias("w"))
        upto = Window.partitionBy("first").orderBy("bin")
        found = (bins.join(nodes, "first")
                 .withColumn("after", F.col("before") + F.sum("w").over(upto))
                 .where(F.col("after") >= F.col("goal"))
                 .groupBy("first").agg(F.min_by(
                     F.struct("dim", "left", "goal",
                              (F.col("start") + F.col("bin") * (1 << shift)).alias("start"),
                              (F.col("after") - F.col("w")).alias("before"),
                              F.col("w").alias("last")), "bin").alias("n"))
                 .select("first", "n.*"))
        keep = ["first", "dim", "left", "goal", "start", "before"]
        nodes = scratch.save(found.select(*keep, "last"), f"nodes-{level}-{step + 1}")
    # The points of the median's own bin go to the side that is nearer to the goal.
    cut = F.col("start") + F.when(
        F.col("goal") - F.col("before") > F.col("last") / 2, 1).otherwise(0)
    cuts = nodes.select("first", "dim", "left", cut.alias("cut"))
    joined = points.join(cuts, "first", "left").withColumn("x", along)
    right = F.col("cut").isNotNull() & (F.col("x") >= F.col("cut"))
    out = joined.select(
        "g", "cell", "w", *names,
        F.when(right, F.col("first") + F.col("left")).otherwise(F.col("first")).alias("first"),
        F.when(F.col("cut").isNull(), F.col("k"))
        .when(right, F.col("k") - F.col("left")).otherwise(F.col("left")).alias("k"),
    )
    return scratch.save(out, f"level-{level}")


def _slots(placed: DataFrame) -> DataFrame:
    """Number the rows of a shard from 0: ranks inside small buckets, plus what the
    buckets before hold."""
    counts = placed.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket")
    starts = counts.select(
        "shard", "bucket", (F.sum("count").over(before) - F.col("count")).alias("base"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")
    ranked = placed.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank")).alias("slot"))
