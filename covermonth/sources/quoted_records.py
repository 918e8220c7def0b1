"""Records with line breaks in quoted fields, read by many tasks per file.

Whether a line break ends a record depends on the quotes before it: on their parity. Each
split counts its own; the parities of a file's splits, chained in order, give the state
in which each split begins. With it, a split puts its lines together to records by itself.
Only the two records that a split cuts, at its beginning and end, leave it as fragments, and are put
together by a shuffle that carries nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MOST_SPLITS = 5_000_000  # their states are broadcast, some hundred bytes each

_WHOLE, _BEGUN, _CONTINUED = 0, 1, 2
_SCHEMA = "uri string, block long, part int, header boolean, record binary"


def quoted_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """RECORD (bytes as text, undecoded) and uri of every record but the first of each file.

    Quotes inside quoted fields are doubled. Lines end in LF or CR LF, which records are without; a
    line break inside a field is kept as it is. Records of blanks only are left out. A quote that is never closed takes
    the rest of its file into one record.
    """
    text = spark.read.text(paths, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"))
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    splits = text.groupBy("uri", "block").agg(F.sum(quotes).alias("quotes"))
    before = (Window.partitionBy("uri").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    states = splits.select("uri", "block", "quotes", inside.alias("inside"))
    # A split is cut if a record goes over its beginning or its end.
    is_cut = F.col("inside") | (F.col("quotes") % 2 == 1)
    states = states.select("uri", "block", "inside", is_cut.alias("cut")).cache()
    if states.count() > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits, raise spark.sql.files.maxPartitionBytes")
    # The lines of a split keep their order: the join has no shuffle.
    lines = text.join(F.broadcast(states), ["uri", "block"], "left").select(
        F.col("value").cast("binary").alias("value"), "uri", "block",
        F.coalesce("inside", F.raise_error(F.lit("a split without a state")).cast("boolean"))
        .alias("inside"), "cut")

    def parts(of_lines: DataFrame) -> DataFrame:
        return of_lines.select("value", "uri", "block", "inside").mapInArrow(_records, _SCHEMA)

    whole = parts(lines).where(F.col("part") == _WHOLE).select("uri", "header", "record")
    # Only lines of cut splits are looked at again.
    found = whole.unionAll(_joined(parts(lines.where("cut")).where(F.col("part") != _WHOLE)))
    # Bytes are cut as bytes: they may be no valid text yet.
    record = F.when(F.endswith("record", F.lit(b"\r")),
                    F.expr("substring(record, 1, octet_length(record) - 1)")).otherwise(F.col("record"))
    return (found.where(~F.col("header")).select("uri", record.cast("string").alias("RECORD"))
            .where(F.trim(F.col("RECORD"), F.lit(" \t\r\n")) != ""))


def _joined(fragments: DataFrame) -> DataFrame:
    """Records that splits cut, from their fragments: a beginning and all that continue it."""
    order = Window.partitionBy("uri").orderBy("block", F.col("part").desc())
    begun = F.sum((F.col("part") == _BEGUN).cast("int")).over(order)
    numbered = fragments.withColumn("number", begun)
    pieces = F.sort_array(F.collect_list(F.struct("block", F.col("record").alias("r"))))
    return numbered.groupBy("uri", "number").agg(
        F.bool_or("header").alias("header"),
        F.aggregate(F.slice(pieces, 2, 1 << 30), pieces[0]["r"],
                    lambda done, p: F.concat(done, F.lit(b"\n"), p["r"])).alias("record")
    ).select("uri", "header", "record")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, held, inside, continued, first = None, [], False, False, False
    for batch in batches:
        uris, blocks = batch.column("uri"), batch.column("block").to_numpy()
        # Runs of lines of one split.
        changes = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
        same_block = pc.not_equal(uris.slice(1), uris.slice(0, max(0, len(uris) - 1)))
        changes = np.union1d(changes, np.flatnonzero(same_block.to_numpy(zero_copy_only=False)) + 1)
        bounds = [0, *changes.tolist(), batch.num_rows]
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            if start == end:
                continue
            now = (uris[start].as_py(), int(blocks[start]))
            if now != key:
                if held:
                    yield _fragment(key, held, continued, first)
                key, held = now, []
                inside = continued = batch.column("inside")[start].as_py()
                first = now[1] == 0
            values = batch.column("value").slice(start, end - start)
            odd = pc.count_substring(values, pattern='"').to_numpy(zero_copy_only=False) & 1
            after = (np.cumsum(odd) + inside) & 1
            before = np.concatenate([[inside], after[:-1]])
            starts = np.flatnonzero(before == 0)
            inside = bool(after[-1])
            if not len(starts):
                held += values.to_pylist()
                continue
            if held or starts[0] > 0:
                held += values.slice(0, int(starts[0])).to_pylist()
                if continued:
                    yield _fragment(key, held, True, False)
                else:
                    yield _whole(key, pa.array([b"\n".join(held)], pa.binary()), first)
                    first = False
                held, continued = [], False
            # The last record of these lines is open while its quotes are.
            ends = [*starts[1:].tolist(), len(values)]
            if inside:
                held = values.slice(int(starts[-1])).to_pylist()
                starts, ends = starts[:-1], ends[:-1]
            if len(starts):
                offsets = pa.array([int(starts[0]), *ends], pa.int32())
                lists = pa.ListArray.from_arrays(offsets, values)
                yield _whole(key, pc.binary_join(lists, b"\n"), first)
                first = False
    if held:
        yield _fragment(key, held, continued, first)


def _whole(key: tuple[str, int], records: pa.Array, first: bool) -> pa.RecordBatch:
    header = np.zeros(len(records), bool)
    header[0] = first
    return _batch(key, _WHOLE, records, header)


def _fragment(key: tuple[str, int], held: list[bytes], continued: bool, first: bool) -> pa.RecordBatch:
    records = pa.array([b"\n".join(held)], pa.binary())
    return _batch(key, _CONTINUED if continued else _BEGUN, records,
                  np.array([first and not continued]))


def _batch(key: tuple[str, int], part: int, records: pa.Array, header: np.ndarray) -> pa.RecordBatch:
    count = len(records)
    return pa.RecordBatch.from_arrays(
        [pa.array([key[0]] * count, pa.string()), pa.array([key[1]] * count, pa.int64()),
         pa.array([part] * count, pa.int32()), pa.array(header), records],
        ["uri", "block", "part", "header", "record"])
