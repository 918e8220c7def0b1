"""Rows that share a key, with all members of each group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The most frequent keys are spread over tasks, if they have so many rows that it matters. Any
# other key has less than a thousandth of all rows.
SPREAD_KEYS = 1000
HOT_ROWS = 10_000

_HASH, _SALT, _COPIES = "_key_hash", "_key_salt", "_copies"


def duplicate_members(
    df: DataFrame, key: list[str] | None = None, count_name: str = "COPIES",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows whose key occurs more than once, with the number of rows that share it.

    Without ``key``, whole rows are compared. NULLs count as equal. A ``count_name`` that ``df``
    has already is an error.

    Most keys occur once, so they are told apart by a 64-bit hash first: each task counts its
    hashes and shuffles 16 bytes for each. Only keys whose hash came up again are counted
    themselves, which makes the result exact, and only keys above one are joined with the rows.
    No group is gathered: one that holds a large part of all rows is counted in tasks
    before any shuffle, and its rows meet copies of its count under salts: this is done for the
    SPREAD_KEYS most frequent keys, if they have ``hot_rows`` rows. The input is
    read four times, with the key's columns only but for the last.
    """
    if count_name in df.columns:
        raise ValueError(f"there is a column {count_name} already")
    key = key or df.columns
    # NULLs leave a hash as it is: their places are hashed too.
    parts = [F.col(c) for c in key] + [F.col(c).isNull() for c in key]
    hashed = df.withColumn(_HASH, F.xxhash64(*parts))
    seen = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    hot = [r[0] for r in seen.where(F.col("_n") >= hot_rows).orderBy(F.desc("_n"), _HASH)
           .limit(SPREAD_KEYS).collect()]
    salts = df.sparkSession.sparkContext.defaultParallelism * 2
    is_hot = F.col(_HASH).isin(hot) if hot else F.lit(False)
    # Salted by the task: the same again if a lost task is run anew.
    salt = F.when(is_hot, F.spark_partition_id() % salts).otherwise(0)
    all_salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0)))
    salted = hashed.withColumn(_SALT, salt)

    suspects = seen.select(_HASH, F.explode(all_salts).alias(_SALT))
    narrow = salted.select(*key, _HASH, _SALT).join(suspects, [_HASH, _SALT], "left_semi")
    repeated = narrow.groupBy(*key, _HASH).agg(F.count(F.lit(1)).alias(_COPIES))
    repeated = repeated.where(F.col(_COPIES) > 1)
    names = {c: f"_key_{i}" for i, c in enumerate(key)}
    repeated = repeated.withColumns({_SALT: F.explode(all_salts)}).select(
        *[F.col(c).alias(n) for c, n in names.items()], F.col(_HASH).alias("_hash_of_key"),
        F.col(_SALT).alias("_salt_of_key"), _COPIES)
    meets = [F.col(_HASH) == F.col("_hash_of_key"), F.col(_SALT) == F.col("_salt_of_key")]
    meets += [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    joined = salted.join(repeated, reduce(Column.__and__, meets))
    return joined.select(*df.columns, F.col(_COPIES).alias(count_name))


def one_of_each(df: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key, always the same: the smallest by all its columns.

    NULLs count as equal and come first. A key's rows are reduced in each task before the shuffle.
    """
    row = F.min(F.struct(*df.columns)).alias("_row")
    return df.groupBy(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(key)]).agg(row).select(
        "_row.*")
