"""Benchmark passages in documents, found by spaced seeds.

A mask marks some of the positions of a short window of words; the words at the marked
positions are hashed, the others may be anything. Seeds of the test items meet seeds of the
documents by hash. Around each hit the item is laid over the document without gaps, and the
overlap with the best score counts if enough of its words agree, or else all that the item covers, so a
passage is found although words of it were replaced.

Bitmaps of fixed size hold the words and the seeds of the tests. Windows with other words are not even
hashed; what a document keeps of its millions of seeds is decided in the task that reads it, and only
documents with such a seed are shuffled, once for all copies of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covermonth.llm.filters import bitmap, possible
from covermonth.llm.scratch import Scratch
from covermonth.llm.words import WordHashes, lists, mix, words

# Six words each; the gaps of the masks differ, so that in items of 8 to 16 words all replacements
# of up to a fifth of the words leave some mask whole, as do any 4 in 17 words.
MASKS = ("11101101", "110110011", "1101001011", "11001010101", "111111", "11010111", "1010011011")
MIN_WORDS = 13  # words that agree in an overlap,
MIN_SHARE = 0.8  # or this share of the item's words,
SHORTEST = 8  # if that is so many words at least
TOGETHER = 300_000  # words looked through at once
AGREEING = 0.75  # share of an overlap's words that agree
PENALTY = 2  # for a word that differs, where one that agrees counts 1

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_STRIPPED = b".,;:!?\"'()[]{}<>*_`-"


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each distinct (doc_id, item_id) whose texts overlap: doc_id, item_id, matched (words
    that agree), first_word and end_word (place of the overlap among the document's words), share (matched by the item's words).

    docs has doc_id and text, items item_id and text; other columns are ignored. Words are in lower
    case (A-Z) and without punctuation at their ends. An overlap counts with 13 agreeing words,
    or 80 percent of the item's words and 8 at least; these 80 percent may lie anywhere in the item. Null and empty texts overlap with
    nothing, nor do items of fewer than 8 words. Repeated rows give the same rows once. Where an item
    overlaps in several places, the one with most agreeing words is given, the first of equals.
    Rows without doc_id are reported as such.
    """
    hits, best = _hits_and_overlaps(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                                    items)
    return (hits.select("doc_id", "node").distinct().join(best, "node")
            .select("doc_id", "item_id", "o.*")
            .groupBy("doc_id", "item_id")
            .agg(F.max_by(F.struct("matched", "first_word", "end_word", "share"),
                          F.struct("matched", F.negate("first_word"))).alias("o"))
            .select("doc_id", "item_id", "o.*"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs whose text overlaps with no item; columns as they are.

    Each row is judged by its own text, whatever rows share its doc_id or have none.
    """
    hits, best = _hits_and_overlaps(
        docs.select(F.lit(None).cast("long").alias("doc_id"), "text"), items)
    found = (hits.join(best.select("node"), "node", "left_semi")
             .select(F.col("digest").alias("contaminated_digest")).distinct())
    return docs.join(
        found, F.sha2(docs["text"].cast("binary"), 256) == found["contaminated_digest"], "left_anti")


def _hits_and_overlaps(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, text) with a seed of an item: doc_id, digest of the text and node, that of its
    words; and node, item_id and the best overlap."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    tests = scratch.save(
        items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
        .mapInArrow(_test_seeds,
                    "item_id long, item_words array<long>, place array<int>, seed array<long>"),
        "tests")
    seeds = scratch.save(
        tests.select("item_id", F.explode(F.arrays_zip("place", "seed")).alias("z"))
        .select("item_id", F.col("z.place").alias("item_place"), F.col("z.seed").alias("seed")),
        "seeds")
    item_words = tests.select(F.explode("item_words").alias("word")).distinct()
    known = spark.sparkContext.broadcast(
        (bitmap(item_words, "word"), bitmap(seeds, "seed", probes=3)))
    hits = scratch.save(
        docs.mapInArrow(lambda batches: _document_seeds(batches, known),
                        "doc_id long, digest string, node binary, words array<long>, "
                        "place array<int>, seed array<long>"),
        "hits")
    texts = scratch.save(
        hits.groupBy("node").agg(*[F.first(c).alias(c) for c in ("words", "place", "seed")]),
        "texts")
    found = (texts.select("node", F.explode(F.arrays_zip("place", "seed")).alias("z"))
             .select("node", F.col("z.place").alias("place"), F.col("z.seed").alias("seed"))
             .join(seeds, "seed")
             .select("node", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
             .distinct())
    laid = (found.join(texts.select("node", "words"), "node")
            .join(tests.select("item_id", "item_words").distinct(), "item_id")
            .select("node", "item_id", "shift", F.greatest("shift", F.lit(0)).alias("start"),
                    "item_words",
                    F.slice("words", F.greatest("shift", F.lit(0)) + 1,
                            F.size("item_words") + F.least("shift", F.lit(0))).alias("window")))
    overlaps = laid.mapInArrow(
        _overlaps, "node binary, item_id long, matched int, first_word int, end_word int, "
        "share double")
    best = (overlaps.groupBy("node", "item_id").agg(
        F.max_by(F.struct("matched", "first_word", "end_word", "share"),
                 F.struct("matched", F.negate("first_word"))).alias("o")))
    return hits, best


class PlainHashes(WordHashes):
    """Hash of each word without the punctuation at its ends; 0 if nothing else is left.

    The last bit tells whether the word may be one of an item, by a bitmap of the items' hashes; of
    items, all are.
    """

    def __init__(self, known: np.ndarray | None = None) -> None:
        super().__init__()
        self.known = known
        self.last = 0 if known is None else len(known) * 64 - 1

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(_STRIPPED)
        if plain == word:
            value = super().__missing__(word) | 1
            if self.known is not None:
                place = value & self.last
                value ^= ~int(self.known[place >> 6]) >> (place & 63) & 1
        else:
            value = self[plain] if plain else 0
        self[word] = value
        return value


def _tokens(text: str | None, memory: PlainHashes) -> np.ndarray:
    hashes = memory.of(words(text))
    return hashes[hashes != 0]


def _seeds(tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and hashes of the windows whose marked words may all be words of items, mask by mask."""
    likely = (tokens & np.uint64(1)).astype(bool)
    for number, mask in enumerate(MASKS):
        windows = len(tokens) - len(mask) + 1
        if windows <= 0:
            continue
        marks = [k for k, mark in enumerate(mask) if mark == "1"]
        whole = likely[marks[0]:marks[0] + windows]
        for k in marks[1:]:
            whole = whole & likely[k:k + windows]
        places = np.flatnonzero(whole)
        if not len(places):
            continue
        # A polynomial of the marked words.
        value = np.full(len(places), number + 1, np.uint64)
        for k in marks:
            value = value * _FACTOR + tokens[places + k]
        yield places.astype(np.int32), mix(value)


def _columns(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[pa.Array]:
    out = []
    for k, kind in enumerate((np.uint64, np.int32, np.uint64)):
        parts = [row[k] for row in rows]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        flat = np.concatenate(parts) if parts else np.zeros(0, kind)
        out.append(lists(flat, offsets) if kind is np.uint64 else pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())))
    return out


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.uint64)
    return np.concatenate([p for p, _ in parts]), np.concatenate([s for _, s in parts])


def _test_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = PlainHashes()
    for batch in batches:
        ids, rows = [], []
        for item, text in zip(batch.column("item_id").to_pylist(),
                              batch.column("text").to_pylist(), strict=True):
            tokens = _tokens(text, memory)
            if len(tokens) >= SHORTEST:
                ids.append(item)
                rows.append((tokens, *_joined(list(_seeds(tokens)))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *_columns(rows)],
            ["item_id", "item_words", "place", "seed"])


def _document_seeds(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    words_of_items, bits = known.value
    memory = PlainHashes(words_of_items)
    for batch in batches:
        held, size = [], 0
        for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            text = text.as_py()
            tokens = _tokens(text, memory)
            held.append((doc.as_py(), text, tokens))
            size += len(tokens)
            if size >= TOGETHER:
                yield _likely_documents(held, bits)
                held, size = [], 0
        if held:
            yield _likely_documents(held, bits)


def _likely_documents(docs: list[tuple[int | None, str, np.ndarray]], bits: np.ndarray) -> pa.RecordBatch:
    """The documents that have a seed of an item, looked through together.

    Between two documents lie words of no item, as many as the longest mask: all masks begin
    and end with a mark, so no window goes over them.
    """
    gap = np.zeros(max(map(len, MASKS)), np.uint64)
    parts = [part for _, _, tokens in docs for part in (tokens, gap)]
    lengths = np.array([len(tokens) + len(gap) for _, _, tokens in docs])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    places, seeds = _joined(list(_seeds(np.concatenate(parts))))
    likely = possible(bits, seeds, probes=3)
    places, seeds = places[likely], seeds[likely]
    owner = np.searchsorted(starts, places, side="right") - 1
    order = np.argsort(owner, kind="stable")
    owner, places, seeds = owner[order], places[order], seeds[order]
    found, firsts = np.unique(owner, return_index=True)
    ends = np.append(firsts, len(owner))[1:]
    ids, digests, nodes, rows = [], [], [], []
    for k, first, end in zip(found.tolist(), firsts, ends, strict=True):
        doc, text, tokens = docs[k]
        ids.append(doc)
        digests.append(hashlib.sha256(text.encode()).hexdigest())
        nodes.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
        rows.append((tokens, (places[first:end] - starts[k]).astype(np.int32), seeds[first:end]))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(digests, pa.string()),
         pa.array(nodes, pa.binary()), *_columns(rows)],
        ["doc_id", "digest", "node", "words", "place", "seed"])


def best_overlap(same: np.ndarray) -> tuple[int, int, int]:
    """Start, end and agreeing words of the stretch with the best score."""
    score = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.flatnonzero(score[:end + 1] == low[end])[-1])
    return start, end, int(same[start:end].sum())


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            item, window = np.array(row["item_words"]), np.array(row["window"])
            skipped = max(0, -row["shift"])
            part = item[skipped:skipped + len(window)]
            same = part == window[:len(part)]
            share = max(SHORTEST, MIN_SHARE * len(item))
            start, end, matched = best_overlap(same)
            if matched < min(MIN_WORDS, share) and same.sum() >= share:
                # A replaced word near an end costs the stretch what agrees beyond it.
                agreeing = np.flatnonzero(same)
                start, end, matched = int(agreeing[0]), int(agreeing[-1]) + 1, len(agreeing)
            enough = matched >= min(MIN_WORDS, share)
            if enough and matched >= AGREEING * (end - start):
                rows.append((row["node"], row["item_id"], matched, row["start"] + start,
                             row["start"] + end, matched / len(item)))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["node", "item_id", "matched", "first_word", "end_word", "share"])
