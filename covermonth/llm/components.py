"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covermonth.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Columns node and root for every node of edges (a, b); root is the smallest node that it
    reaches. Nodes can be of any type with an order.

    Alternates the large-star and small-star steps of Kiveris and others, "Connected
    components in MapReduce and beyond" (2014). A step joins edges with one minimum per node,
    so a node with very many edges needs no list of its neighbours, and the number of edges
    does not grow. Each round is written, which cuts the lineage.
    """
    edges = scratch.save(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-0")
    state = _state(edges)
    step = 0
    while True:
        step += 1
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = scratch.save(large, f"{name}-large-{step}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where(F.col("b") != F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least).distinct())
        edges = scratch.save(small, f"{name}-{step}")
        scratch.drop(f"{name}-large-{step}")
        scratch.drop(f"{name}-{step - 1}")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    pair = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(pair), F.sum(F.shiftright(pair, 20))).first())
