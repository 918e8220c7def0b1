"""A class-based bigram model: exchange clustering, class transitions, word emissions.

P(word | before) = P(class(word) | class(before)) * P(word | class(word)).

Every word of the training rows is put into a class by exchange: into that which raises the
likelihood of the neighbouring classes most. Three steps, the statistics of which Spark counts:

1. The CORE most frequent words are moved in rounds until nothing is gained, from the counts of
   their pairs, as in Uszkoreit and Brants, "Distributed word clustering for large scale
   class-based language modeling" (2008): within a round the counts of neighbours are those of its start.
2. All words of the dictionary, of fixed size, are moved in PLACEMENTS rounds by the classes before
   and after them, those beyond the core in tasks: at first only core words have classes, then all have.
3. All words outside the dictionary, however many, are placed in tasks by the classes before
   them. Their classes and counts stay in Spark, and texts meet them in a join.

As the word before, a word outside the dictionary counts as one class more, REST: it is predicted
by a class of its own and predicts as a rare word. Texts are tokenised twice, to count
and to write their words as numbers; all passes after that read the numbers.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth.llm.scratch import Scratch
from covermonth.llm.words import WordHashes, longs, words

CLASSES = 64
REST = CLASSES  # class before: words outside the dictionary, and words not yet placed
STATES = CLASSES + 1
CORE = 2048  # frequent words that are exchanged in rounds
PLACEMENTS = 5  # rounds over the whole dictionary
DICTIONARY = 1 << 18  # words whose counts and classes are broadcast
BUCKETS = 64  # of the dictionary: what one task places
HELD = 300_000  # words that a task counts before it hands its counts on
ROUNDS = 10
ADDED = 0.1  # to each word's count
PRIOR = 10.0  # weight of the class frequencies in the transitions of a class
END = b"\n"  # no word contains white space
STEP = 16  # words of a bucket that move at the same time
ROWS = 1000  # texts that a task works on at once
PIECE = 256  # counts of neighbours in a row, so that an Arrow batch of 10,000 rows is 20 MB at most
CELLS = 1 << 16  # counted cells that a task hands on at once


@dataclass
class Model:
    """What scoring needs besides the classes and counts of words outside the dictionary."""

    counts: np.ndarray  # of the dictionary
    class_of: np.ndarray  # of the dictionary, then REST
    transitions: np.ndarray  # log10 P(class | state before)
    emission_total: np.ndarray  # log10 of the denominator of P(word | class)
    train_tokens: int
    distinct: int


def score(docs: DataFrame, held_out: Column, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs (doc_id, text).

    The model is trained on the rows where held_out (never null) is false. Tokens are the words of a whole
    text in lower case (A-Z), then one end. base_score is the log10 probability under word
    frequencies, score under the class model. Null and empty texts are one end. Repeated rows
    count and are scored like any, rows without doc_id too. Other columns are ignored. Without
    training rows every token is unknown.
    """
    scratch = scratch or Scratch(docs.sparkSession, "brown")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
                       "text")
    _, counts, outside, codes = encode(rows, scratch)
    model, others = train(codes.where(~F.col("held_out")), counts, outside, scratch)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    parts = scratch.save(
        codes.mapInArrow(
            lambda batches: _score(batches, shared),
            "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
            "score double, hashes array<long>, states array<int>, times array<long>"), "parts")
    # A word that was not trained on may be of any class: class REST has the sum over all.
    gain = model.transitions - model.emission_total
    gain = np.column_stack([gain, np.log10((10 ** gain).sum(axis=1))])
    cells = docs.sparkSession.createDataFrame(  # at most STATES * STATES rows
        [(s, c, float(gain[s, c])) for s in range(STATES) for c in range(STATES)],
        "state int, class int, gain double")
    counted = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + ADDED)
    met = (parts.select("row", F.explode(F.arrays_zip("hashes", "states", "times")).alias("z"))
           .select("row", F.col("z.hashes").alias("hash"), F.col("z.states").alias("state"),
                   F.col("z.times").alias("times"))
           .join(others, "hash", "left")
           .withColumn("class", F.coalesce("class", F.lit(REST)))
           .join(F.broadcast(cells), ["state", "class"])
           .groupBy("row").agg(
               F.sum(counted).alias("more"), F.sum(F.col("times") * F.col("gain")).alias("gain"),
               F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("known")))
    more = F.coalesce("more", F.lit(0.0))
    return parts.drop("hashes", "states", "times").join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more + F.coalesce("gain", F.lit(0.0))).alias("score"))


def encode(rows: DataFrame, scratch: Scratch
           ) -> tuple[list[bytes], np.ndarray, int, DataFrame]:
    """The dictionary, its counts, how many training words are outside, and each row's tokens as numbers.

    Codes are places in the dictionary, -1 outside it; others are the hashes of the words
    outside, in the order of the text. The 64-bit hash is taken as the word.
    """
    counts = scratch.save(
        rows.where(~F.col("held_out")).select("text")
        .mapInArrow(_count_words, "hash long, word binary, n long")
        # Tasks have added up theirs, so rows are not added up again before the shuffle. As a
        # key a word can stand in a hash table, as a minimum its rows would be sorted.
        .repartition("hash").groupBy("hash", "word").agg(F.sum("n").alias("n")), "counts")
    dictionary, known, outside = _most_frequent(counts)
    shared = rows.sparkSession.sparkContext.broadcast(dictionary)
    codes = rows.mapInArrow(lambda batches: _encode(batches, shared),
                            "doc_id long, held_out boolean, codes binary, others binary")
    return dictionary, known, outside, scratch.save(
        codes.withColumn("row", F.monotonically_increasing_id()), "codes")


def train(training: DataFrame, counts: np.ndarray, outside: int, scratch: Scratch
          ) -> tuple[Model, DataFrame]:
    """The model, and hash, class and n of all words outside the dictionary, from training rows as numbers."""
    class_of, same = exchange(scratch.save(core_pairs(training), "pairs"), counts)
    class_of, table = refine(training, class_of, same)

    # Words outside the dictionary have no class to be predicted by yet.
    cells = table[:, :CLASSES].copy()
    placed = place_others(training, class_of, cells, outside, scratch)
    added = _cells(placed.where("hash IS NULL").select("cell", "n"))
    cells += added.reshape(STATES, STATES)[:, :CLASSES]
    others = placed.where("hash IS NOT NULL").select("hash", "class", "n")

    tokens = cells.sum(axis=0)
    own = class_of[:-1]
    distinct = np.bincount(own, minlength=CLASSES)
    for row in others.groupBy("class").count().collect():  # at most CLASSES rows
        distinct[row["class"]] += row["count"]
    total = tokens.sum()
    prior = (tokens + 1) / (total + CLASSES)
    smooth = (cells + PRIOR * prior) / (cells.sum(axis=1, keepdims=True) + PRIOR)
    return Model(counts, class_of, np.log10(smooth), np.log10(tokens + ADDED * (distinct + 1)),
                 int(total), int(distinct.sum())), others


def _most_frequent(counts: DataFrame) -> tuple[list[bytes], np.ndarray, int]:
    """At most DICTIONARY words and their counts, the most frequent first after the end; how many are left.

    Frequencies fall into steps of a 64th of a power of two. The dictionary holds all words of the
    steps that fit as a whole, so that no task has to sort the candidates of all others.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 64)
    steps = counts.groupBy(step.alias("step")).count().collect()  # at most 64 * 63 rows
    least, total = 64 * 64, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["count"]
        if total >= DICTIONARY:
            break
        least = row["step"]
    # The end is in the dictionary even where few texts are trained on.
    top = counts.where((step >= least) | (F.col("word") == F.lit(END))).toArrow()
    found = sorted(
        zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True),
        key=lambda r: (r[0] != END, -r[1], r[0]))
    return ([w for w, _ in found], np.array([n for _, n in found], np.int64),
            sum(row["count"] for row in steps) - len(found))


# --- the core ---------------------------------------------------------------------

def core_pairs(training: DataFrame) -> DataFrame:
    """How often core word b follows core word a; all other words are one, number CORE."""
    units = CORE + 1
    return (training.select("codes").mapInArrow(_count_pairs, "pair int, n long")
            .groupBy("pair").agg(F.sum("n").alias("n"))
            .select(F.floor(F.col("pair") / units).cast("int").alias("a"),
                    (F.col("pair") % units).alias("b"), "n"))


def exchange(pairs: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each word of the dictionary (REST beyond the core), and how often core words follow themselves."""
    spark = pairs.sparkSession
    order = np.arange(min(CORE, len(counts)))  # the most frequent first
    class_of = np.full(CORE + 1, REST, np.int64)
    class_of[order] = order % CLASSES
    same = np.zeros(CORE + 1, np.int64)
    for a, n in pairs.where("a = b").select("a", "n").collect():  # at most CORE + 1 rows
        same[a] = n
    best = None
    for _ in range(ROUNDS):
        right, left = _by_class(spark, pairs, class_of)
        table = np.zeros((STATES, STATES))
        np.add.at(table, class_of, right)
        value = likelihood(table)
        if best is not None and value <= best[0] * (1 - 1e-5 * np.sign(best[0])):
            if value > best[0]:
                best = (value, class_of)
            break
        best = (value, class_of)
        class_of = move(class_of.copy(), order, table.copy(), right, left, same)
    whole = np.full(len(counts) + 1, REST, np.int64)
    whole[order] = best[1][order]
    return whole, same


def _by_class(spark, pairs: DataFrame, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit, how often a unit of each class follows it, and comes before it."""
    table = spark.createDataFrame(
        [(u, int(c)) for u, c in enumerate(class_of)], "unit int, class int")
    out = []
    for unit, other in (("a", "b"), ("b", "a")):
        found = (pairs.join(F.broadcast(table.withColumnRenamed("unit", other)), other)
                 .groupBy(unit, "class").agg(F.sum("n").alias("n"))).toArrow()
        counts = np.zeros((len(class_of), STATES))
        counts[found.column(unit).to_numpy(), found.column("class").to_numpy()] = (
            found.column("n").to_numpy())
        out.append(counts)
    return out[0], out[1]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of the classes of a text, up to what no clustering changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=1)).sum()
                 - _xlogx(table.sum(axis=0)).sum())


def move(class_of: np.ndarray, order: np.ndarray, table: np.ndarray, right: np.ndarray,
         left: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Move each unit, the most frequent first, to the class that gains most."""
    for unit in order:
        own = class_of[unit]
        after, before = right[unit].copy(), left[unit].copy()
        # A unit next to itself moves at both ends; these pairs are counted apart.
        twice = min(same[unit], after[own], before[own])
        after[own] -= twice
        before[own] -= twice
        if not after.any() and not before.any():
            continue
        table[own] -= after
        table[:, own] -= before
        table[own, own] -= twice
        np.maximum(table, 0, out=table)
        rows, columns = table.sum(axis=1), table.sum(axis=0)
        diagonal = np.diagonal(table)
        gain = (_xlogx(table + after) - _xlogx(table)).sum(axis=1)
        gain += (_xlogx(table + before[:, None]) - _xlogx(table)).sum(axis=0)
        gain += (_xlogx(diagonal + after + before + twice) - _xlogx(diagonal + after)
                 - _xlogx(diagonal + before) + _xlogx(diagonal))
        gain -= _xlogx(rows + after.sum() + twice) - _xlogx(rows)
        gain -= _xlogx(columns + before.sum() + twice) - _xlogx(columns)
        gain = gain[:CLASSES]
        new = int(gain.argmax()) if gain.max() > gain[own] + 1e-9 else own
        table[new] += after
        table[:, new] += before
        table[new, new] += twice
        class_of[unit] = new
    return class_of


# --- all other words ----------------------------------------------------------------

def best_classes(cells: np.ndarray, starts: np.ndarray, place: np.ndarray, n: np.ndarray,
                 own: np.ndarray, logs: np.ndarray | None = None) -> np.ndarray:
    """The class in which each word raises the likelihood most: its own on ties, then the first.

    cells has a row per kind of neighbour, STATES to a side, with that neighbour's counts next to
    each class. Word k has n[j] neighbours of the kind place[j], j from starts[k] on, and is in
    the class own[k] (REST: in none), whose counts are taken without it. Classes without words
    are left to the core: to words that move at the same time all of them look alike. logs is
    _xlogx(cells), if the caller keeps it.
    """
    if logs is None:
        logs = _xlogx(cells)
    now = cells[place]
    now += n[:, None]
    gains = np.log(now)
    gains *= now
    gains -= logs[place]
    word = np.flatnonzero(own < CLASSES)
    if len(word):
        member = np.repeat(own, np.diff(starts, append=len(n)))
        at = np.flatnonzero(member < CLASSES)
        here = cells[place[at], member[at]]
        gains[at, member[at]] = _xlogx(here) - _xlogx(np.maximum(here - n[at], 0))
    gains = np.add.reduceat(gains, starts)
    sides = len(cells) // STATES
    for k in range(sides):
        total = cells[k * STATES:(k + 1) * STATES].sum(axis=0)
        if k == 0:
            filled = total > 0
        size = np.add.reduceat(n if sides == 1 else np.where(place // STATES == k, n, 0), starts)
        change = _xlogx(total + size[:, None]) - _xlogx(total)
        if len(word):
            here = total[own[word]]
            change[word, own[word]] = _xlogx(here) - _xlogx(np.maximum(here - size[word], 0))
        gains -= change
    if len(word):
        gains[word, own[word]] += 1e-9
    if not filled.all():
        gains[:, ~filled] = -np.inf
    return gains.argmax(axis=1)


def place(cells: np.ndarray, starts: np.ndarray, kinds: np.ndarray, n: np.ndarray,
          own: np.ndarray, share: float) -> np.ndarray:
    """The classes of words that move one small group after the other; cells is changed.

    The words are a random share of those that move at the same time elsewhere, so each move is
    counted as 1 / share moves. Without this, words of one kind would all find the same class best.
    """
    out = own.copy()
    logs = _xlogx(cells)
    ends = np.append(starts[1:], len(n))
    for first in range(0, len(starts), STEP):
        last = min(first + STEP, len(starts))
        entries = slice(starts[first], ends[last - 1])
        found = best_classes(cells, starts[first:last] - starts[first], kinds[entries],
                             n[entries], own[first:last], logs)
        length = ends[first:last] - starts[first:last]
        old, new = np.repeat(own[first:last], length), np.repeat(found, length)
        moved = old != new
        kind, times = kinds[entries][moved], n[entries][moved] / share
        old, new = old[moved], new[moved]
        there = old < CLASSES
        left, entered = (kind[there], old[there]), (kind, new)
        np.subtract.at(cells, left, times[there])
        np.add.at(cells, entered, times)
        for changed in (left, entered):
            cells[changed] = np.maximum(cells[changed], 0)
            logs[changed] = _xlogx(cells[changed])
        out[first:last] = found
    return out


def refine(training: DataFrame, class_of: np.ndarray, same: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """Exchange over the whole dictionary: classes, and the counts of neighbouring states.

    A round counts the neighbours of all words by class, then moves core words one by
    one and the others in tasks. The classes of the best round are kept.
    """
    core = min(CORE, len(class_of) - 1)
    best = None
    for done in range(PLACEMENTS + 1):
        counted = _cells(training.select("codes").mapInArrow(_with(_dictionary_cells, training, class_of),
                                             "cell int, n long"),
                         STATES * STATES + CORE * 2 * STATES)
        table = counted[:STATES * STATES].reshape(STATES, STATES)
        near = counted[STATES * STATES:].reshape(CORE, 2, STATES)
        value = likelihood(table)
        # At the start words beyond the core have no classes, which cannot be compared.
        if done <= 1 or value > best[0]:
            best = (value, class_of, table)
        if done == PLACEMENTS or len(class_of) - 1 <= CORE:
            break
        moved = place_dictionary(training, class_of, table)
        moved[:core] = move(class_of[:core].copy(), np.arange(core), table.copy(),
                            near[:, 1].copy(), near[:, 0].copy(), same)
        class_of = moved
    return best[1], best[2]


def place_dictionary(training: DataFrame, class_of: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The classes, with the words beyond the core in those that gain most by both their neighbours."""
    size = len(class_of) - 1
    cells = np.concatenate([table[:, :CLASSES], table[:CLASSES].T])
    found = (training.select("codes").mapInArrow(_with(_neighbours, training, class_of),
                                 "bucket int, keys binary, times binary")
             .repartition(BUCKETS, "bucket")
             .mapInArrow(lambda batches: _place(batches, cells, class_of),
                         "word int, class int")).toArrow()  # at most DICTIONARY rows
    out = class_of.copy()
    out[found.column("word").to_numpy()] = found.column("class").to_numpy()
    return out


def place_others(training: DataFrame, class_of: np.ndarray, cells: np.ndarray, others: int,
                 scratch: Scratch) -> DataFrame:
    """hash, class and n of each word outside the dictionary; rows without hash count cells of states and classes."""
    found = (training.select("codes", "others").mapInArrow(_with(_other_words, training, class_of),
                                 "hash long, state int, n long")
             .repartition("hash").groupBy("hash", "state").agg(F.sum("n").alias("n"))
             .groupBy("hash").agg(F.collect_list(F.struct("state", "n")).alias("before")))
    return scratch.save(found.mapInArrow(
        lambda batches: _place_others(batches, cells, others),
        "hash long, class int, cell int, n long"), "others")


def _cells(rows: DataFrame, size: int = STATES * STATES) -> np.ndarray:
    found = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most size rows
    out = np.zeros(size)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


# --- in tasks ---------------------------------------------------------------------

def _with(function, training: DataFrame, class_of: np.ndarray):
    shared = training.sparkSession.sparkContext.broadcast(class_of)
    return lambda batches: function(batches, shared.value)


def _some_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ROWS rows, which bound what numpy holds besides them."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _counted(table: np.ndarray, name: str) -> Iterator[pa.RecordBatch]:
    """Cells with a count, in small batches: Spark's side holds a whole one outside of its heap."""
    there = np.flatnonzero(table)
    for first in range(0, len(there), CELLS):
        some = there[first:first + CELLS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(table[some], pa.int64())], [name, "n"])


def _tokens(text: str | None) -> list[bytes]:
    return [*words(text), END]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def batch_of() -> pa.RecordBatch:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts))
        return pa.RecordBatch.from_arrays(
            [longs(hashes), pa.array(counts.keys(), pa.binary()),
             pa.array(counts.values(), pa.int64())], ["hash", "word", "n"])

    for batch in _some_rows(batches):
        for text in batch.column("text").to_pylist():
            counts.update(_tokens(text))
            if len(counts) > HELD:
                yield batch_of()
                counts.clear()
    if counts:
        yield batch_of()


def _encode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    place = {word: k for k, word in enumerate(shared.value)}
    hashes = WordHashes()
    for batch in _some_rows(batches):
        codes, others = [], []
        for text in batch.column("text").to_pylist():
            tokens = _tokens(text)
            code = np.fromiter(map(place.get, tokens, itertools.repeat(-1)), np.int32, len(tokens))
            codes.append(code.tobytes())
            outside = np.flatnonzero(code < 0).tolist()
            others.append(hashes.of([tokens[k] for k in outside]).tobytes() if outside else b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(codes, pa.binary()),
             pa.array(others, pa.binary())], ["doc_id", "held_out", "codes", "others"])


def _numbers(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _before(states: np.ndarray, end: int) -> np.ndarray:
    """What comes before each token of whole texts in a row: each begins after an end, and ends with one."""
    return np.concatenate([np.array([end], states.dtype), states[:-1]])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A task's pairs are as many as units times units at most.
    table = np.zeros((CORE + 1) ** 2, np.int64)
    for batch in _some_rows(batches):
        code = _numbers(batch.column("codes"), np.int32).astype(np.int64)
        unit = np.where((code >= 0) & (code < CORE), code, CORE)
        np.add.at(table, _before(unit, 0) * (CORE + 1) + unit, 1)
    yield from _counted(table, "pair")


def _dictionary_cells(batches: Iterator[pa.RecordBatch], class_of: np.ndarray
                      ) -> Iterator[pa.RecordBatch]:
    """Counts of states after states; behind them, of the states before and after each core word."""
    table = np.zeros(STATES * STATES + CORE * 2 * STATES, np.int64)
    for batch in _some_rows(batches):
        code = _numbers(batch.column("codes"), np.int32)
        state = class_of[code]
        before, after = _before(state, class_of[0]), np.roll(state, -1)
        np.add.at(table, before * STATES + state, 1)
        at = np.flatnonzero((code >= 0) & (code < CORE))
        first = STATES * STATES + code[at].astype(np.int64) * (2 * STATES)
        np.add.at(table, first + before[at], 1)
        np.add.at(table, first + STATES + after[at], 1)
    yield from _counted(table, "cell")


def _neighbours(batches: Iterator[pa.RecordBatch], class_of: np.ndarray
                ) -> Iterator[pa.RecordBatch]:
    """Counts of the states before and after each word beyond the core, in rows of PIECE of a bucket's."""
    held: list[np.ndarray] = []
    total = 0

    def batch_of() -> pa.RecordBatch:
        keys, times = np.unique(np.concatenate(held), return_counts=True)
        bucket = (keys // (2 * STATES) % BUCKETS).astype(np.int8)
        pieces = []
        for b in range(BUCKETS):
            part = np.flatnonzero(bucket == b)
            pieces += [(b, part[k:k + PIECE]) for k in range(0, len(part), PIECE)]
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in pieces], pa.int32()),
             pa.array([keys[p].tobytes() for _, p in pieces], pa.binary()),
             pa.array([times[p].astype(np.int32).tobytes() for _, p in pieces], pa.binary())],
            ["bucket", "keys", "times"])

    for batch in _some_rows(batches):
        code = _numbers(batch.column("codes"), np.int32)
        state = class_of[code].astype(np.int32)
        at = np.flatnonzero(code >= CORE)  # never the end, which closes each text
        key = code[at] * np.int32(2 * STATES)  # below 2 ** 31, by the size of the dictionary
        held += [key + _before(state, class_of[0])[at], key + np.int32(STATES) + state[at + 1]]
        total += 2 * len(at)
        if total >= 4_000_000:
            yield batch_of()
            held, total = [], 0
    if held:
        yield batch_of()


def _place(batches: Iterator[pa.RecordBatch], cells: np.ndarray, class_of: np.ndarray
           ) -> Iterator[pa.RecordBatch]:
    """Classes of the words of whole buckets: a table of fixed size, whatever the rows."""
    tables: dict[int, np.ndarray] = {}
    rows = -(-len(class_of) // BUCKETS)
    for batch in batches:
        for bucket, keys, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            table = tables.get(bucket)
            if table is None:
                table = tables[bucket] = np.zeros((rows, 2 * STATES), np.int64)
            word, kind = np.divmod(np.frombuffer(keys, np.int32), 2 * STATES)
            table[word // BUCKETS, kind] += np.frombuffer(times, np.int32)
    for bucket, table in tables.items():
        word, kind = np.nonzero(table)
        if not len(word):
            continue
        there, starts = np.unique(word, return_index=True)
        own = class_of[there * BUCKETS + bucket]
        yield pa.RecordBatch.from_arrays(
            [pa.array(there * BUCKETS + bucket, pa.int32()),
             pa.array(place(cells.copy(), starts, kind, table[word, kind], own, 1 / BUCKETS),
                      pa.int32())],
            ["word", "class"])


def _other_words(batches: Iterator[pa.RecordBatch], class_of: np.ndarray
                 ) -> Iterator[pa.RecordBatch]:
    """Counts of the states before each word outside the dictionary."""
    for batch in batches:
        code = _numbers(batch.column("codes"), np.int32)
        before = _before(class_of[code], class_of[0])[code < 0]
        hashes = _numbers(batch.column("others"), np.uint64)
        order = np.lexsort((before, hashes))
        hashes, before = hashes[order], before[order]
        first = np.flatnonzero(np.concatenate([
            [True] * min(1, len(hashes)),
            (hashes[1:] != hashes[:-1]) | (before[1:] != before[:-1])]))
        yield pa.RecordBatch.from_arrays(
            [longs(hashes[first]), pa.array(before[first], pa.int32()),
             pa.array(np.diff(first, append=len(hashes)), pa.int64())], ["hash", "state", "n"])


def _place_others(batches: Iterator[pa.RecordBatch], cells: np.ndarray, others: int
                  ) -> Iterator[pa.RecordBatch]:
    names = ["hash", "class", "cell", "n"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    table = np.zeros(STATES * STATES, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("before")
        starts = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
        flat = lists.flatten()
        state, n = flat.field("state").to_numpy(), flat.field("n").to_numpy()
        found = place(cells.copy(), starts, state, n, np.full(len(starts), REST),
                      len(starts) / others)
        length = np.diff(starts, append=len(state))
        np.add.at(table, state * STATES + np.repeat(found, length), n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("hash"), pa.array(found, kinds[1]), pa.nulls(len(found), kinds[2]),
             pa.array(np.add.reduceat(n, starts), kinds[3])], names)
    there = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(there), kinds[0]), pa.nulls(len(there), kinds[1]),
         pa.array(there, kinds[2]), pa.array(table[there])], names)


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = Model(**shared.value)
    log_count = np.log10(model.counts + ADDED)
    total = np.log10(model.train_tokens + ADDED * (model.distinct + 1))
    gain = model.transitions - model.emission_total
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()),
             pa.list_(pa.int32()), pa.list_(pa.int64()))
    for batch in _some_rows(batches):
        columns: list[list] = [[] for _ in kinds]
        for codes, others in zip(batch.column("codes").to_pylist(),
                                 batch.column("others").to_pylist(), strict=True):
            code = np.frombuffer(codes, np.int32)
            state = model.class_of[code]
            before = _before(state, model.class_of[0])
            known = code >= 0
            counted = log_count[code[known]].sum()
            outside = Counter(zip(np.frombuffer(others, np.int64).tolist(),
                                  before[~known].tolist(), strict=True))
            for column, value in zip(columns, (
                len(code), int(known.sum()), counted - len(code) * total,
                counted + gain[before[known], state[known]].sum(),
                [h for h, _ in outside], [s for _, s in outside], list(outside.values()),
            ), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("held_out"),
             *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "hashes",
             "states", "times"])
