"""Hard negatives: rows of another label that score just below an anchor's positives.

Scores are inner products of whole-number vectors. A pair is scored only if it can matter. Each row
stores its angles to a few reference directions; by the triangle inequality of angles, the angle
between two rows lies between the difference and the sum of their angles to a direction, so its
cosine lies in an interval, the narrowest of those that the directions give. Times both norms, and
widened by more than rounding can add up to, these are bounds of the score. Positives ask for
scores above the fifth best so far; negatives for scores in the windows that the positives set. Rows
are sorted by their angle to the first direction, so what can reach an anchor's window is one range.

Anchors are met in chunks of a bounded size, each broadcast to the tasks that read the rows; rows are not
shuffled. A task keeps, for each anchor of the chunk, the best few only, and the best of all tasks are ranked by
Spark. So neither a hot label nor a vector that very many rows repeat makes a large group anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covermonth.llm.scratch import Scratch
from covermonth.llm.vectors import clean, exact_kind, matrices

DIRECTIONS = 4
SAMPLE = 256  # rows that reference directions are chosen from; any choice gives the same result
CHUNK = 4096  # anchors met at once, on average
TILE = 256  # anchors scored at once
SAFE = 4e-6  # of the product of the norms: more than single precision loses

_LEAST = -(1 << 62)
_FOUND = "anchor long, slot int, score long, id long, n long"


@dataclass
class Anchors:
    """A chunk of anchors of one vector length, and what is asked for each.

    For each of its slots an anchor wants the `wanted` best rows with low <= score <= high, of its
    label or of others.
    """

    n: np.ndarray
    label: np.ndarray
    q: np.ndarray
    angles: np.ndarray
    low: np.ndarray  # [anchor, slot]
    high: np.ndarray

    def take(self, places: np.ndarray) -> Anchors:
        return Anchors(*[getattr(self, f)[places] for f in self.__dataclass_fields__])


def hard_negatives(rows: DataFrame, anchors: Column, vector: str = "embedding",
                   positives: int = 5, negatives: int = 3, low: Fraction = Fraction(1, 2),
                   high: Fraction = Fraction(95, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    rows has vec_id, label and `vector`; `anchors` says of a row whether it is an anchor (null: no).
    A score is the inner product of floor(256 x); higher ones come first, ties by smaller vec_id, rows
    without vec_id last. An anchor's positives are its first `positives` other rows of its label, and for each
    the first `negatives` rows of other labels with
    low * positive_score <= score <= high * positive_score are given, ranked from 1.

    Rows without label or vector, or with a null, NaN or infinite component, take no part. Rows that
    repeat others are rows of their own, as anchors too. Only vectors of the same length are
    compared. All-zero vectors score 0. Components of 65,536 or more are an error. Other columns
    are ignored; an empty table gives no rows. Labels that are not whole numbers are met by a
    64-bit hash.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    kept = clean(rows.where(F.col("label").isNotNull()), vector,
                 vec_id=F.col("vec_id").cast("long"), label=_label_number(rows),
                 anchor=F.coalesce(anchors, F.lit(False)))
    shared = spark.sparkContext.broadcast(_directions(kept))
    # Numbers of rows are fixed once they are written.
    numbered = kept.withColumn("n", F.monotonically_increasing_id())
    table = scratch.save(numbered.mapInArrow(
        lambda batches: _with_angles(batches, shared),
        "n long, vec_id long, label long, anchor boolean, q array<long>, angles array<double>"),
        "rows")
    asking = table.where("anchor")
    chunks = -(-asking.count() // CHUNK)
    asking = scratch.save(
        asking.withColumn("chunk", F.pmod(F.xxhash64("n"), F.lit(max(1, chunks)))), "anchors")
    if not chunks:
        return table.select(
            F.col("vec_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"),
            F.lit(0).alias("rank"), F.col("vec_id").alias("negative_id"),
            F.col("n").alias("positive_score"), F.col("n").alias("negative_score")).where("false")
    for chunk in range(chunks):
        mine = asking.where(F.col("chunk") == chunk)
        queries = _anchors(mine.select("n", "label", "q", "angles").toArrow())
        found = _search(table, queries, positives, True)
        best = scratch.save(
            found.join(mine.select(F.col("n").alias("anchor"), F.col("vec_id").alias("anchor_id")),
                       "anchor"), f"positives/chunk={chunk}")
        windows = _windows(best.select("anchor", "rank", "score").toArrow(), queries, positives,
                           low, high)
        near = scratch.save(_search(table, windows, negatives, False), f"negatives/chunk={chunk}")
    of_positives = scratch.read("positives", best.schema).select(
        "anchor", F.col("rank").alias("slot"), "anchor_id", F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    return (scratch.read("negatives", near.schema).withColumn("slot", F.col("slot") + 1)
            .join(of_positives, ["anchor", "slot"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def _label_number(rows: DataFrame) -> Column:
    """Whole numbers are labels as they are; of other labels, the 64-bit hash is taken."""
    if rows.schema["label"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.col("label").cast("long")
    return F.xxhash64("label")


def _directions(kept: DataFrame) -> np.ndarray:
    """Unit vectors as far apart as they can be chosen one by one from a bounded sample."""
    sample = kept.orderBy(F.xxhash64("vec_id", "label"), "q").select("q").limit(SAMPLE).collect()
    longest = max((len(row["q"]) for row in sample), default=0)
    points = np.zeros((len(sample) + 1, max(1, longest)))
    points[-1, 0] = 1.0
    for k, row in enumerate(sample):
        points[k, :len(row["q"])] = row["q"]
    norms = np.linalg.norm(points, axis=1)
    points = points[norms > 0] / norms[norms > 0][:, None]
    chosen = [0]
    nearest = points @ points[0]
    while len(chosen) < min(DIRECTIONS, len(points)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    return points[chosen]


def _with_angles(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    directions = shared.value
    for batch in batches:
        angles = np.zeros((batch.num_rows, len(directions)))
        for places, vectors in matrices(batch.column("q")):
            angles[places] = angles_to(vectors, directions)
        flat = pa.ListArray.from_arrays(
            pa.array(np.arange(batch.num_rows + 1) * len(directions), pa.int32()),
            pa.array(angles.reshape(-1)))
        names = ["n", "vec_id", "label", "anchor", "q"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], flat], [*names, "angles"])


def angles_to(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of each vector to each direction, cut or filled with zeros to the vectors' length;
    0 for a vector of zeros, whose products are 0 at any angle."""
    length = vectors.shape[1]
    fitted = np.zeros((len(directions), length))
    shared = min(length, directions.shape[1])
    fitted[:, :shared] = directions[:, :shared]
    norms = np.linalg.norm(fitted, axis=1)
    if length:
        fitted[norms == 0, 0] = 1.0
    fitted /= np.where(norms == 0, 1.0, norms)[:, None]
    own = np.linalg.norm(vectors.astype(float), axis=1)
    cosines = (vectors @ fitted.T) / np.where(own == 0, 1.0, own)[:, None]
    return np.where(own[:, None] == 0, 0.0, np.arccos(np.clip(cosines, -1.0, 1.0)))


def _anchors(table: pa.Table) -> list[Anchors]:
    """Anchors by vector length, in the order of their first angle."""
    if not table.num_rows:
        return []
    table = table.combine_chunks()
    column = table.column("q").chunk(0)
    n, label = table.column("n").to_numpy(), table.column("label").to_numpy()
    angles = table.column("angles").chunk(0)
    angles = angles.values.to_numpy().reshape(table.num_rows, -1)
    out = []
    for places, vectors in matrices(column):
        places_sorted = np.argsort(angles[places, 0], kind="stable")
        at = places[places_sorted]
        low = np.full((len(at), 1), _LEAST, np.int64)
        out.append(Anchors(n[at], label[at], vectors[places_sorted], angles[at], low, -low))
    return out


def _windows(best: pa.Table, queries: list[Anchors], positives: int, low: Fraction,
             high: Fraction) -> list[Anchors]:
    """The same anchors, one slot for each positive: the scores its negatives may have."""
    anchor = best.column("anchor").to_numpy()
    slot = best.column("rank").to_numpy() - 1
    score = best.column("score").to_numpy().astype(object)  # products of any size
    least = [-(-s * low.numerator // low.denominator) for s in score]
    most = [s * high.numerator // high.denominator for s in score]
    out = []
    for group in queries:
        order = np.argsort(group.n)
        place = np.minimum(np.searchsorted(group.n[order], anchor), len(order) - 1)
        mine = group.n[order][place] == anchor
        lows = np.full((len(group.n), positives), -_LEAST, np.int64)  # above any score
        highs = np.full((len(group.n), positives), _LEAST, np.int64)
        at = order[place[mine]]
        lows[at, slot[mine]] = np.array(least, object)[mine].astype(np.int64)
        highs[at, slot[mine]] = np.array(most, object)[mine].astype(np.int64)
        some = (lows <= highs).any(1)
        picked = group.take(np.flatnonzero(some))
        picked.low, picked.high = lows[some], highs[some]
        if some.any():
            out.append(picked)
    return out


def _search(table: DataFrame, queries: list[Anchors], wanted: int, same_label: bool) -> DataFrame:
    """anchor, slot, score, id and rank of the best rows for each slot of the anchors."""
    shared = table.sparkSession.sparkContext.broadcast([vars(group) for group in queries])
    found = table.select("n", "vec_id", "label", "q", "angles").mapInArrow(
        lambda batches: _best_of_task(batches, shared, wanted, same_label), _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(
        F.col("score").desc(), F.col("id").asc_nulls_last(), "n")
    return (found.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= wanted).drop("n"))


class Best:
    """The best rows so far for each slot of some anchors."""

    def __init__(self, anchors: Anchors, wanted: int) -> None:
        self.anchors, self.wanted = anchors, wanted
        self.slots = anchors.low.shape[1]
        self.scores = np.full((len(anchors.n) * self.slots, wanted), _LEAST, np.int64)
        self.ids = np.zeros(self.scores.shape, np.int64)
        self.rows = np.full(self.scores.shape, -1, np.int64)

    def floor(self) -> np.ndarray:
        """The score that a row has to reach, [anchor, slot]."""
        return np.maximum(self.anchors.low, self.scores[:, -1].reshape(-1, self.slots))

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Rows for keys (anchor times slots, plus slot)."""
        touched = np.unique(key)
        old = np.repeat(touched, self.wanted)
        key = np.concatenate([key, old])
        score = np.concatenate([score, self.scores[touched].reshape(-1)])
        ids = np.concatenate([ids, self.ids[touched].reshape(-1)])
        rows = np.concatenate([rows, self.rows[touched].reshape(-1)])
        order = np.lexsort((rows, ids, -score, key))
        key, score, ids, rows = key[order], score[order], ids[order], rows[order]
        starts = np.searchsorted(key, touched)
        at = starts[:, None] + np.arange(self.wanted)
        self.scores[touched], self.ids[touched], self.rows[touched] = score[at], ids[at], rows[at]

    def results(self) -> tuple[np.ndarray, ...]:
        key, place = np.nonzero(self.rows >= 0)
        return (self.anchors.n[key // self.slots], (key % self.slots).astype(np.int32),
                self.scores[key, place], self.ids[key, place], self.rows[key, place])


_LAST = (1 << 63) - 1  # the place of a row without vec_id in the order of ids


def _best_of_task(batches: Iterator[pa.RecordBatch], shared, wanted: int,
                  same_label: bool) -> Iterator[pa.RecordBatch]:
    best = [[Best(group.take(np.arange(at, min(at + TILE, len(group.n)))), wanted)
             for at in range(0, len(group.n), TILE)]
            for group in (Anchors(**fields) for fields in shared.value)]
    for batch in batches:
        ids = batch.column("vec_id").fill_null(_LAST).to_numpy()
        n, label = batch.column("n").to_numpy(), batch.column("label").to_numpy()
        all_angles = batch.column("angles").values.to_numpy().reshape(batch.num_rows, -1)
        for places, vectors in matrices(batch.column("q")):
            tiles = [t for group in best if group and group[0].anchors.q.shape[1] == vectors.shape[1]
                     for t in group]
            order = np.argsort(all_angles[places, 0], kind="stable")
            rows = _Rows(n[places[order]], ids[places[order]], label[places[order]],
                         vectors[order], all_angles[places[order]])
            for tile in tiles:
                _score(tile, rows, same_label)
    out = [np.concatenate(c) for c in zip(*[t.results() for g in best for t in g], strict=True)]
    if out:
        anchors, slots, scores, ids, rows = out
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors), pa.array(slots), pa.array(scores),
             pa.array(ids, mask=ids == _LAST), pa.array(rows)],
            ["anchor", "slot", "score", "id", "n"])


class _Rows:
    """Rows of one vector length, in the order of their first angle."""

    def __init__(self, n, ids, label, q, angles) -> None:
        self.n, self.ids, self.label, self.q, self.angles = n, ids, label, q, angles
        self.norms = np.linalg.norm(q.astype(float), axis=1)
        self.most = self.norms.max(initial=0.0)
        self.cos = np.cos(angles).T.astype(np.float32)
        self.sin = np.sin(angles).T.astype(np.float32)


def bounds(angles: np.ndarray, cos: np.ndarray, sin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest cosine of each pair: the narrowest over all directions."""
    least = most = None
    for k in range(angles.shape[1]):
        along = np.cos(angles[:, k]).astype(np.float32)[:, None] * cos[k]
        across = np.sin(angles[:, k]).astype(np.float32)[:, None] * sin[k]
        upper, lower = along + across, along - across
        most = upper if most is None else np.minimum(most, upper, out=most)
        least = lower if least is None else np.maximum(least, lower, out=least)
    return least, most


def _score(tile: Best, rows: _Rows, same_label: bool) -> None:
    anchors = tile.anchors
    floor = tile.floor()
    norms = np.linalg.norm(anchors.q.astype(float), axis=1)
    open_slots = floor <= anchors.high
    low = np.where(open_slots, floor, -_LEAST).min(1).astype(float)
    high = np.where(open_slots, anchors.high, _LEAST).max(1).astype(float)
    # Rows whose first angle is near enough to reach the lowest floor: one range.
    reach = np.divide(low, norms * rows.most, out=np.full(len(low), -1.0),
                      where=norms * rows.most > 0)
    width = np.arccos(np.clip(reach - SAFE, -1.0, 1.0)) + 1e-9
    start = np.searchsorted(rows.angles[:, 0], (anchors.angles[:, 0] - width).min())
    end = np.searchsorted(rows.angles[:, 0], (anchors.angles[:, 0] + width).max(), side="right")
    if start >= end:
        return
    part = slice(start, end)
    least, most = bounds(anchors.angles, rows.cos[:, part], rows.sin[:, part])
    scale = norms[:, None].astype(np.float32) * rows.norms[None, part].astype(np.float32)
    slack = scale * np.float32(SAFE) + np.float32(1.0)
    likely = (most * scale + slack >= low.astype(np.float32)[:, None] - _rounded(low)[:, None])
    likely &= least * scale - slack <= high.astype(np.float32)[:, None] + _rounded(high)[:, None]
    likely &= (anchors.label[:, None] == rows.label[None, part]) == same_label
    columns = np.flatnonzero(likely.any(0))
    if not len(columns):
        return
    kind = exact_kind(norms.max() * rows.most + 1.0)
    picked = columns + start
    scores = anchors.q.astype(kind) @ rows.q[picked].astype(kind).T
    hit = likely[:, columns] & (scores >= np.where(open_slots, floor, -_LEAST).min(1)[:, None])
    at, place = np.nonzero(hit)
    score, place = scores[at, place].astype(np.int64), picked[place]
    for slot in range(tile.slots):
        inside = (score >= floor[at, slot]) & (score <= anchors.high[at, slot])
        inside &= rows.n[place] != anchors.n[at]
        if inside.any():
            tile.add(at[inside] * tile.slots + slot, score[inside], rows.ids[place[inside]],
                     rows.n[place[inside]])


def _rounded(limit: np.ndarray) -> np.ndarray:
    """More than a limit can change when it is rounded to single precision."""
    return (np.abs(limit) * 1e-6).astype(np.float32)
