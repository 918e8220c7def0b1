"""Product codes of vectors: codebooks by ball k-means.

A vector is cut into equal parts, and each part is replaced by the number of the nearest entry
of its position's codebook. Codebooks start from given vectors and are moved by rounds of
assignment and averaging, over all vectors.

An assignment does not compare every part with every entry. The parts of an entry lie in a ball
around it; only entries less than two radii away can take a part from it, and these are its
neighbours. A part less than half way to the nearest neighbour is in the stable core and stays
without any comparison. The others lie in rings: a part at distance d has the neighbours up to distance 2d
as its candidates. All of this is decided on squares of whole numbers, so results are
those of a full search, ties to the lower number included.

What is gathered in a round is one sum, count and radius for each entry (16 times 64), whatever the
number of vectors. Assignments stay in tables, and each round starts from those of the last.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covermonth.llm.scratch import Scratch
from covermonth.llm.vectors import clean, exact_kind, matrices

PARTS = 16
ENTRIES = 64
ROUNDS = 2
BATCH = 32_768  # vectors assigned at once
SMALL = 100_000  # labels whose sums are broadcast

_ROW = "vec_id long, label {label}, q array<long>, code binary, error long"


class Book:
    """Entries of all part positions, [part, entry, component], and the balls around them.

    `reach` is an upper bound of the radius of each entry's ball.
    """

    def __init__(self, entries: np.ndarray, reach: np.ndarray | None = None) -> None:
        self.entries = entries
        parts, count, _ = entries.shape
        if reach is None:
            reach = np.full((parts, count), math.inf)
        self.reach = reach
        gaps = entries[:, :, None, :] - entries[:, None, :, :]
        self.apart = (gaps * gaps).sum(-1)  # squared distances between entries
        self.neighbours: list[list[np.ndarray]] = []
        self.rings: list[list[np.ndarray]] = []
        for part in range(parts):
            near, rings = [], []
            for entry in range(count):
                apart = self.apart[part, entry]
                # One more than the bound: a root that was rounded down loses nothing.
                inside = apart <= 4.0 * (reach[part, entry] + 1.0) ** 2
                inside[entry] = False
                order = np.flatnonzero(inside)
                order = order[np.argsort(apart[order], kind="stable")]
                near.append(order)
                rings.append(apart[order])
            self.neighbours.append(near)
            self.rings.append(rings)

    def assign(self, vectors: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared distances [vector, part], from the codes of the last assignment."""
        parts, _, width = self.entries.shape
        codes = codes.copy()
        distances = np.zeros(codes.shape, np.int64)
        for part in range(parts):
            own = vectors[:, part * width:(part + 1) * width]
            book = self.entries[part]
            gap = own - book[codes[:, part]]
            distance = np.einsum("ij,ij->i", gap, gap)
            order = np.argsort(codes[:, part], kind="stable")
            bounds = np.searchsorted(codes[order, part], np.arange(len(book) + 1))
            for entry in range(len(book)):
                ball = order[bounds[entry]:bounds[entry + 1]]
                rings = self.rings[part][entry]
                if not len(ball) or not len(rings):
                    continue
                # Neighbours at a distance of 2d or less; equal ones can win a tie.
                ring = np.searchsorted(rings, 4 * distance[ball], side="right")
                moving = ball[ring > 0]
                if not len(moving):
                    continue
                near = self.neighbours[part][entry][:ring.max()]
                candidates = np.sort(np.append(near, entry))
                squares = _squares(own[moving], book[candidates])
                best = squares.argmin(1)  # the first of equals: the lowest number
                codes[moving, part] = candidates[best]
                distance[moving] = squares[np.arange(len(moving)), best]
            distances[:, part] = distance
        return codes, distances

    def moved(self, sums: np.ndarray, counts: np.ndarray, widest: np.ndarray) -> Book:
        """Entries at the averages of their parts, rounded down; unused ones stay."""
        used = counts > 0
        new = np.where(used[:, :, None], sums // np.maximum(counts, 1)[:, :, None], self.entries)
        shift = np.sqrt(((new - self.entries) ** 2).sum(-1).astype(float))
        return Book(new, np.sqrt(widest.astype(float)) + shift)

    @property
    def sha256(self) -> str:
        text = ",".join(map(str, self.entries.reshape(-1).tolist()))
        return hashlib.sha256(text.encode()).hexdigest()


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to some entries, exact."""
    width = points.shape[1]
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = exact_kind(4.0 * max(1, width) * most * most)
    a, b = points.astype(kind), entries.astype(kind)
    out = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return out.astype(np.int64)


def encode(rows: DataFrame, vector: str = "embedding", parts: int = PARTS,
           entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every usable vector.

    rows has vec_id, label and `vector`; other columns are ignored. Components become
    floor(256 x). A codebook starts as its part of the `entries` smallest vec_ids (of rows that
    repeat a vec_id, the smallest vector; nulls last); if there are fewer, it has fewer entries.

    code has two hexadecimal digits for each part; error is the sum of squared distances, label_error
    its sum over rows with an equal label, nulls together. Rows without a vector, or with a null, NaN
    or infinite component, are left out. Repeated rows are rows of their own. A vector whose length is
    not that of the first one has null code and error; if that length is not a multiple of
    `parts`, ValueError. Components of 65,536 or more are an error. An empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = rows.sparkSession
    scratch = Scratch(spark, "codes")
    table = scratch.save(
        clean(rows, vector, vec_id=F.col("vec_id").cast("long"), label=F.col("label")), "rows")
    book = _first_book(table, parts, entries)
    if book is None:
        return table.select(
            "vec_id", "label", F.lit(None).cast("string").alias("code"),
            F.lit(None).cast("long").alias("error"), F.lit(None).cast("long").alias("label_error"),
            F.lit(None).cast("string").alias("codebooks_sha256"))
    schema = _ROW.format(label=table.schema["label"].dataType.simpleString())
    table = table.withColumns({"code": F.lit(None).cast("binary"),
                               "error": F.lit(None).cast("long")})
    for turn in range(rounds):
        table = scratch.save(_assigned(table, book, schema), f"round-{turn}")
        scratch.drop("rows" if turn == 0 else f"round-{turn - 1}")
        book = book.moved(*_balls(table, book))
    coded = scratch.save(
        _assigned(table, book, schema).select(
            "vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"), "coded")
    scratch.drop(f"round-{rounds - 1}")
    sums = scratch.save(
        coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    if sums.count() <= SMALL:
        sums = F.broadcast(sums)
    of_label = sums.withColumnRenamed("label", "label_summed")
    return (coded.join(of_label, F.col("label").eqNullSafe(F.col("label_summed")), "left")
            .select("vec_id", "label", "code", "error", "label_error",
                    F.lit(book.sha256).alias("codebooks_sha256")))


def _first_book(table: DataFrame, parts: int, entries: int) -> Book | None:
    ids = [row[0] for row in table.select("vec_id").distinct()
           .orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    if not ids:
        return None
    known = F.col("vec_id").isin([i for i in ids if i is not None])
    if None in ids:
        known = known | F.col("vec_id").isNull()
    first = {row["vec_id"]: row["q"] for row in
             table.where(known).groupBy("vec_id").agg(F.min("q").alias("q")).collect()}
    length = len(first[ids[0]])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    vectors = np.array([first[i] for i in ids if len(first[i]) == length], np.int64)
    return Book(vectors.reshape(len(vectors), parts, length // parts).transpose(1, 0, 2).copy())


def _assigned(table: DataFrame, book: Book, schema: str) -> DataFrame:
    """The rows with code and error under a codebook; their former code is where the search starts."""
    shared = table.sparkSession.sparkContext.broadcast((book.entries, book.reach))
    return table.select("vec_id", "label", "q", "code", "error").mapInArrow(
        lambda batches: _assign_batches(batches, shared), schema)


def _assign_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    book = Book(*shared.value)
    parts, _, width = book.entries.shape
    for batch in _joined(batches):
        codes: list[bytes | None] = [None] * batch.num_rows
        errors: list[int | None] = [None] * batch.num_rows
        former = batch.column("code")
        for places, vectors in matrices(batch.column("q")):
            if vectors.shape[1] != parts * width:
                continue
            known = former.take(pa.array(places))
            if known.null_count:
                start = np.zeros((len(places), parts), np.int64)  # all in the ball of entry 0
            else:
                start = np.frombuffer(b"".join(known.to_pylist()), np.uint8).reshape(-1, parts)
            found, squares = book.assign(vectors, start.astype(np.int64))
            total = squares.sum(1)
            packed = found.astype(np.uint8)
            for k, place in enumerate(places.tolist()):
                codes[place] = packed[k].tobytes()
                errors[place] = int(total[k])
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), batch.column("q"),
             pa.array(codes, pa.binary()), pa.array(errors, pa.int64())],
            ["vec_id", "label", "q", "code", "error"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Larger batches: a ball then holds enough parts to be worth a product of matrices."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BATCH:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _balls(table: DataFrame, book: Book) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts and largest squared distance of the parts of every entry."""
    parts, count, width = book.entries.shape
    shared = table.sparkSession.sparkContext.broadcast(book.entries)
    found = (table.where(F.col("code").isNotNull()).select("q", "code")
             .mapInArrow(lambda batches: _sum_batches(batches, shared),
                         "part int, entry int, component int, total long, n long, widest long")
             .groupBy("part", "entry", "component")
             .agg(F.sum("total"), F.sum("n"), F.max("widest"))).collect()
    sums = np.zeros((parts, count, max(width, 1)), np.int64)
    counts = np.zeros((parts, count), np.int64)
    widest = np.zeros((parts, count), np.int64)
    for part, entry, component, total, n, most in found:  # one for each entry and component
        sums[part, entry, component] = total
        counts[part, entry], widest[part, entry] = n, most
    return sums[:, :, :width], counts, widest


def _sum_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    entries = shared.value
    parts, count, width = entries.shape
    sums = np.zeros((parts, count, max(width, 1)), np.int64)
    counts = np.zeros((parts, count), np.int64)
    widest = np.zeros((parts, count), np.int64)
    for batch in batches:
        codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8)
        codes = codes.reshape(-1, parts).astype(np.int64)
        for places, vectors in matrices(batch.column("q")):
            for part in range(parts):
                own, at = vectors[:, part * width:(part + 1) * width], codes[places, part]
                np.add.at(sums[part, :, :width], at, own)
                counts[part] += np.bincount(at, minlength=count)
                gap = own - entries[part][at]
                np.maximum.at(widest[part], at, np.einsum("ij,ij->i", gap, gap))
    part, entry, component = (a.reshape(-1) for a in np.indices(sums.shape))
    there = counts[part, entry] > 0
    part, entry, component = part[there], entry[there], component[there]
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(component, pa.int32()),
         pa.array(sums[part, entry, component]), pa.array(counts[part, entry]),
         pa.array(widest[part, entry])],
        ["part", "entry", "component", "total", "n", "widest"])


def decode(code: Column, book: Book, spark: SparkSession) -> Column:
    """The whole numbers that a code stands for; null of a null code."""
    shared = spark.sparkContext.broadcast(book.entries)

    def rebuild(codes: pa.Array) -> pa.Array:
        entries = shared.value
        return pa.array([None if c is None else np.concatenate(
            [entries[p, k] for p, k in enumerate(bytes.fromhex(c))]).tolist()
            for c in codes.to_pylist()], pa.list_(pa.int64()))

    return F.arrow_udf(rebuild, "array<long>")(code)
