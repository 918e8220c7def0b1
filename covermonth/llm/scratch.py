"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Spark's limit of rows alone lets a batch grow with the length of texts.
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, Python tasks get their rows in Arrow batches of about BATCH_BYTES, unless the session
    sets a size. Both sides hold whole batches, Spark outside of its heap."""
    if spark.conf.get(_BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_BYTES, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, or that of setCheckpointDir.

    A session on one machine that names none, as in tests, gets a temporary one. On a
    cluster such a folder would be another one on each machine, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not folder:
        if context.getCheckpointDir():
            return context.getCheckpointDir().rstrip("/")
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="covermonth-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


class Scratch:
    """Tables of one run of an operator. Writing a table cuts the lineage: what reads it
    later survives lost executors, and its rows stay the same when a task is repeated."""

    def __init__(self, spark: SparkSession, owner: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{owner}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with small_batches(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str, schema: StructType) -> DataFrame:
        """All tables saved in a folder of this name."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)
