"""Paths on whatever file system Spark is configured for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def _children(spark: SparkSession, path: str) -> list:
    return list(_file_system(spark, path).listStatus(_path(spark, path)))


def list_names(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Names of the files and folders in ``path`` that end in ``suffix``."""
    names = [s.getPath().getName() for s in _children(spark, path)]
    return sorted(n for n in names if n.endswith(suffix) and not n.startswith(("_", ".")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    stream = _file_system(spark, path).create(_path(spark, path), True)
    stream.write(bytearray(text.encode()))
    stream.close()


def require_path(spark: SparkSession, path: str | None, what: str) -> None:
    if not path:
        raise ValueError(f"no {what} given")
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{what} does not exist: {path}")


def staging_path(target: str) -> str:
    """A new hidden path next to ``target``, on the same file system."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_staging-{uuid.uuid4().hex}/{name}"


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put ``staged`` in the place of ``target``.

    The old target is kept aside until the new one is in place, and put back
    if that fails.
    """
    fs = _file_system(spark, target)
    new, old = _path(spark, staged), _path(spark, target)
    aside = _path(spark, staged + ".replaced")
    replaces = fs.exists(old)
    if replaces and not fs.rename(old, aside):
        raise OSError(f"cannot replace {target}")
    try:
        if not fs.rename(new, old):
            raise OSError(f"cannot move {staged} to {target}")
    except Exception:
        if replaces:
            fs.rename(aside, old)
        raise
    discard(spark, staged)


def discard(spark: SparkSession, staged: str) -> None:
    """Remove the staging folder that holds ``staged``."""
    folder = _path(spark, staged).getParent()
    if not folder.getName().startswith("_staging-"):
        raise ValueError(f"not a staging path: {staged}")
    _file_system(spark, staged).delete(folder, True)
