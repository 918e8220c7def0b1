"""Inventory of source folders: every file, what it is, and how it begins.

Spark's own readers leave out hidden files without a word, and know a file only by reading it
whole. This data source lists folders in tasks, one row per file, and reads no more of a file than
its first lines:

    spark.read.format("source_files").option("root", ...).load()

Tables of it stay in Spark: guards are filters on them, and what was read can be held against them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

READ, HIDDEN, EMPTY, OTHER, MARK = "read", "hidden", "empty", "other", "mark"
FIRST_BLOCK = 64 * 1024
_PARTITIONS = 200
_COLUMNS = ("PATH string, FOLDER string, FILE string, BYTES long, KIND string, HEAD binary, "
            "HAS_ROWS boolean, BYTES_READ long")
_BLANK = b" \t\r\n\x0b\x0c"


class Folders(InputPartition):
    """Folders that one task lists."""

    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class SourceFiles(DataSource):
    """Options: ``root``; ``suffixes``, by commas; ``depth``, 0 for the files in ``root``, 1 for
    those in its subfolders; ``head``, whether the first line of files is wanted."""

    @classmethod
    def name(cls) -> str:
        return "source_files"

    def schema(self) -> str:
        return _COLUMNS

    def reader(self, schema) -> SourceFilesReader:
        return SourceFilesReader(dict(self.options))


class SourceFilesReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root = options["root"].rstrip("/")
        self.suffixes = tuple(s.lower() for s in options["suffixes"].split(","))
        self.depth = int(options.get("depth", "1"))
        self.head = str(options.get("head", "false")).lower() == "true"

    def partitions(self) -> list[Folders]:
        system, root = file_system(self.root)
        if self.depth == 0:
            return [Folders([root])]
        # Names of folders only: one per delivery.
        folders = sorted(f.path for f in system.get_file_info(pa_fs.FileSelector(root))
                         if f.type == pa_fs.FileType.Directory)
        groups = [folders[i::_PARTITIONS] for i in range(min(_PARTITIONS, len(folders)))]
        return [Folders(group) for group in groups] or [Folders([])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.root)
        schema = pa.schema([("PATH", pa.string()), ("FOLDER", pa.string()), ("FILE", pa.string()),
                            ("BYTES", pa.int64()), ("KIND", pa.string()), ("HEAD", pa.binary()),
                            ("HAS_ROWS", pa.bool_()), ("BYTES_READ", pa.int64())])
        for folder in partition.paths:
            rows = []
            for file in system.get_file_info(pa_fs.FileSelector(folder)):
                if file.type != pa_fs.FileType.File:
                    continue
                kind = self._kind(file.base_name, file.size)
                head, has_rows, size = None, None, 0
                if self.head and kind in (READ, HIDDEN):
                    with system.open_input_stream(file.path, buffer_size=None) as stream:
                        head, has_rows, size = first_line(stream)
                rows.append((file.path, folder.rpartition("/")[2], file.base_name, file.size,
                             kind, head, has_rows, size))
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def _kind(self, name: str, size: int) -> str:
        if name == "_SUCCESS" or (name.startswith(".") and name.endswith(".crc")):
            return MARK
        if not name.lower().endswith(self.suffixes):
            return OTHER
        if size == 0:
            return EMPTY
        # Spark's readers do not see these.
        return HIDDEN if name.startswith(("_", ".")) else READ


def file_system(path: str) -> tuple[pa_fs.FileSystem, str]:
    """File system and path of a URI, in driver and tasks alike."""
    scheme, separator, rest = path.partition("://")
    if not separator and path.startswith("file:"):
        return pa_fs.LocalFileSystem(), path[5:]
    if scheme == "file" or not separator:
        return pa_fs.LocalFileSystem(), rest if separator else path
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return pa_fs.FileSystem.from_uri(f"{known}://{rest}")


def first_line(stream) -> tuple[bytes, bool, int]:
    """The first line of a file, whether anything but blanks follows it, and the bytes read."""
    held, size = b"", 0
    while True:
        block = stream.read(FIRST_BLOCK)
        held, size = held + block, size + len(block)
        ends = [at for at in (held.find(b"\n"), held.find(b"\r")) if at >= 0]
        if ends or not block:
            break
    end = min(ends, default=len(held))
    head, rest = held[:end], held[end:]
    while not (found := rest.strip(_BLANK)) and block:
        block = rest = stream.read(FIRST_BLOCK)
        size += len(block)
    return head, bool(found), size


def source_files(
    spark: SparkSession, root: str, suffixes: tuple[str, ...], depth: int = 1, head: bool = False,
) -> DataFrame:
    """One row per file: PATH, FOLDER, FILE, BYTES, KIND, HEAD, HAS_ROWS and BYTES_READ.

    KIND is ``read`` for files with one of the suffixes (in any case of letters),
    ``hidden`` if such a file starts with _ or a dot, ``empty`` if it has no
    byte, ``mark`` for what Hadoop's writers put beside their files, and ``other`` for all others. HEAD is the first line.
    """
    spark.dataSource.register(SourceFiles)
    return (spark.read.format("source_files").option("root", root)
            .option("suffixes", ",".join(suffixes)).option("depth", str(depth))
            .option("head", str(head)).load())


def unread_files(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files that were to be read and gave no row: FOLDER and FILE."""
    found = rows.select("FOLDER", "FILE").distinct()
    return (files.where(F.col("KIND") == READ).select("FOLDER", "FILE")
            .join(found, ["FOLDER", "FILE"], "left_anti"))
