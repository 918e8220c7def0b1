"""Documents packed into sequences of a fixed length by exact complements.

Documents become pieces of at most `size` tokens. How many pieces there are of each length
is a table of `size` numbers, whatever the corpus; the plan is made from it alone. For the
longest length left, one, two or three other lengths that exactly fill the gap are looked up by
their sum and used as often as all of them are there. What finds no exact complement goes
best-fit decreasing into the sequences that leave least. A plan is a short list of patterns with the number of times each
is used; a piece finds its sequence by its rank among the pieces of its length.
"""

from __future__ import annotations

import itertools
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covermonth.llm.scratch import Scratch

SIZE = 4096
END = 1
REMEMBERED = 24 << 20  # bytes of words and ids that a task keeps; then it starts anew
_TEXTS = 250  # whose words are looked up together
_WORD_BYTES = 150  # of a word in a dictionary, beside its characters and ids


@dataclass
class Plan:
    """Patterns of lengths and how often each is used; sequences are numbered through."""

    size: int
    patterns: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    def add(self, lengths: tuple[int, ...], times: int) -> None:
        self.patterns.append((lengths, times))

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.patterns)

    def places(self) -> tuple[np.ndarray, ...]:
        """Arrays, sorted by length and rank: length, first rank, first sequence, offset."""
        rows, used, sequence = [], {}, 0
        for lengths, times in self.patterns:
            offset = 0
            for length in lengths:
                rank = used.get(length, 0)
                rows.append((length, rank, sequence, offset))
                used[length] = rank + times
                offset += length
            sequence += times
        rows.sort()
        return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (
            tuple(np.zeros(0, np.int64) for _ in range(4)))


def plan(counts: np.ndarray, size: int = SIZE) -> Plan:
    """Patterns for counts[length] pieces of each length from 1 to size.

    Pieces longer than half a sequence come first, each with the exact complement of its gap: they
    need sequences of their own, and what is short is wanted there. What is left goes best-fit,
    or exactly into sequences of short pieces first, whichever needs fewer; a plan never needs more
    than best-fit decreasing alone.
    """
    plans = [_exact(counts, size, lowest) for lowest in (size // 2, 0)]
    plain = Plan(size)
    _best_fit(np.array([0, *counts[1:]], np.int64), plain)
    return min([*plans, plain], key=lambda p: p.sequences)


def _exact(counts: np.ndarray, size: int, lowest: int) -> Plan:
    """Exact complements for all lengths above `lowest`, then best-fit."""
    left = np.array(counts, np.int64)
    left[0] = 0
    out = Plan(size)
    if left[size]:
        out.add((size,), int(left[size]))
        left[size] = 0
    sums = Sums(left)
    for length in range(size - 1, lowest, -1):
        while left[length] and (found := sums.complement(length, size - length)):
            lengths, need = np.unique([length, *found], return_counts=True)
            times = int((left[lengths] // need).min())
            out.add((length, *found), times)
            sums.take(lengths, need * times)
    _best_fit(left, out)
    return out


class Sums:
    """Index of the sums of one, two and three lengths that are there.

    Counts of pairs by their sum are made once and kept up to date as lengths are used up.
    A triple is a length and a pair, so it is looked up in the same index.
    """

    def __init__(self, left: np.ndarray) -> None:
        self.left = left
        self.there = left > 0
        flags = self.there.astype(np.int64)
        self.pairs = np.convolve(flags, flags)  # ordered pairs of lengths, by sum

    def take(self, lengths: np.ndarray, numbers: np.ndarray) -> None:
        self.left[lengths] -= numbers
        for gone in lengths[self.left[lengths] == 0].tolist():
            self.there[gone] = False
            self.pairs[gone + np.flatnonzero(self.there)] -= 2
            self.pairs[2 * gone] -= 1

    def complement(self, length: int, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths that are there and add up to gap, beside one of `length`."""
        if gap < 1:
            return None
        if self.left[gap] > (gap == length):
            return (gap,)
        if found := self._pair(gap, (length,)):
            return found
        firsts = np.arange(1, gap - 1)
        likely = firsts[self.there[firsts] & (self.pairs[gap - firsts] > 0)]
        for first in likely[::-1].tolist():
            if first * 3 < gap:
                break
            if self.left[first] > (first == length) and (
                    found := self._pair(gap - first, (length, first))):
                return (first, *found)
        return None

    def _pair(self, total: int, used: tuple[int, ...]) -> tuple[int, int] | None:
        """Two lengths with a sum, beside those used; the most unlike ones."""
        if total < 2 or not self.pairs[total]:
            return None
        low = np.arange(1, total // 2 + 1)
        for small in low[self.there[low] & self.there[total - low]].tolist():
            large = total - small
            if self.left[small] > used.count(small) + (small == large) and (
                    self.left[large] > used.count(large)):
                return (large, small)
        return None


def _best_fit(left: np.ndarray, out: Plan) -> None:
    """Best-fit decreasing for what is left, many equal sequences at a time."""
    open_by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(len(left) - 1, 0, -1):
        count = int(left[length])
        while count:
            gap = min((g for g in open_by_gap if g >= length), default=None)
            if gap is None:
                each = out.size // length
                if full := count // each:
                    _put(open_by_gap, out, (length,) * each, full)
                if rest := count % each:
                    _put(open_by_gap, out, (length,) * rest, 1)
                break
            lengths, times = open_by_gap[gap].pop()
            used = min(times, count)
            if times > used:
                open_by_gap[gap].append((lengths, times - used))
            if not open_by_gap[gap]:
                del open_by_gap[gap]
            _put(open_by_gap, out, (*lengths, length), used)
            count -= used
    for groups in open_by_gap.values():
        for lengths, times in groups:
            out.add(lengths, times)


def _put(open_by_gap: dict, out: Plan, lengths: tuple[int, ...], times: int) -> None:
    gap = out.size - sum(lengths)
    if gap:
        open_by_gap.setdefault(gap, []).append((lengths, times))
    else:
        out.add(lengths, times)


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of docs (doc_id, text).

    A document is the ids of its whole text and then `end`; only documents longer than
    `size` are cut. A null text is empty: its document is the end token alone. Repeated rows,
    and rows without doc_id, are documents of their own. Offsets in a sequence have no gaps.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.save(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            lambda batches: _pieces(batches, tokenizer, size, end),
            "doc_id long, piece int, start long, length long, ids_crc32 long"),
        "pieces")
    counts = np.zeros(size + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `size` rows
        counts[row["length"]] = row["count"]
    places = spark.sparkContext.broadcast(plan(counts, size).places())

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        lengths, ranks, sequences, offsets = places.value
        key = _key(lengths, ranks)
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(key, _key(length, rank), side="right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])],
            ["sequence_id", "offset"])

    placed = F.arrow_udf(place, "struct<sequence_id:long,offset:long>")("length", "rank")
    return _ranked(pieces).withColumn("place", placed).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, size: int = SIZE,
              end: int = END) -> DataFrame:
    """sequence_id and ids of every sequence, for documents with distinct ids."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: _pieces(batches, tokenizer, size, end, keep_ids=True),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>")
    rows = packed.select("doc_id", "piece", "sequence_id", "offset").join(
        ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    # A sequence has at most `size` tokens.
    return rows.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                              lambda p: p["ids"])).alias("ids"))


def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (length << 44) + rank


def _ranked(pieces: DataFrame) -> DataFrame:
    """Rank of each piece among those of its length, counted in buckets: a length that
    very many pieces have is ranked by many tasks."""
    buckets = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket")
    bases = counts.select(
        "length", "bucket", (F.sum("count").over(before) - F.col("count")).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (dealt.withColumn("own", F.row_number().over(inside) - 1)
            .join(bases, ["length", "bucket"])
            .withColumn("rank", F.col("base") + F.col("own")))


class _Numbers(dict):
    """A number for each piece, in the order in which they come up."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


# Characters below U+0180 are letters, numbers, white space or others whatever their neighbours; none
# changes by composition, and all but one (U+0130) have one character in lower case.
_SIMPLE = 0x180


def _class_of(first: str) -> str:
    """The characters below U+0180 whose Unicode category starts with a letter, for a regular expression."""
    return "".join(re.escape(chr(c)) for c in range(_SIMPLE)
                   if unicodedata.category(chr(c)).startswith(first))


# The pattern by which the tokenizer cuts texts, and its white space.
_SPACE = "\\t-\\r \\x85\\xa0"
_PIECE = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_class_of('L')}]+|[{_class_of('N')}]"
    f"|[^{_SPACE}{_class_of('L')}{_class_of('N')}]+")
_NOT_SIMPLE = re.compile("[\u0130\u0180-\U0010ffff]|<\\|")
_PROBE = "It's 12.5% of l'\u00c9cole <b>na\u00efve</b>; they'll, \u00bd \x1c\x07 don''t..."


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the tokenizer's vocabulary: itself if it can be
    printed, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


_BYTE_LETTERS = _byte_letters()


class WordIds:
    """Token ids of whole texts, piece by piece.

    The tokenizer takes texts in lower case and cuts them into runs of letters, single digits and runs of other
    characters, each of which is tokenized by itself. The same cut is made here, and a piece that was
    seen before is not tokenized again. Words with characters of other scripts, or with
    what may be a special token, go through the tokenizer as they are; it joins nothing
    across ASCII white space.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._empty()
        whole = self.tokenizer.encode(_PROBE, add_special_tokens=False).ids
        if self.of([_PROBE])[0].tolist() != whole:
            raise ValueError(f"{path} does not cut texts as its pieces are cut here")

    def _empty(self) -> None:
        self.number = _Numbers()
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.held = 0  # bytes, about

    def of(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > REMEMBERED:
            self._empty()
        known = len(self.number)
        places = []
        for text in texts:
            pieces = self._cut(text)
            places.append(np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces)))
        self._learn(list(itertools.islice(self.number, known, None)))
        return [self._gather(p) for p in places]

    def _cut(self, text: str) -> list[str]:
        if not _NOT_SIMPLE.search(text):
            return _PIECE.findall(text.lower())
        pieces, simple = [], []
        for word in re.split("[\t-\r ]+", text):
            if _NOT_SIMPLE.search(word):
                pieces += _PIECE.findall(" ".join(simple).lower())
                pieces.append(" " + word)  # the blank marks it: no piece holds one
                simple = []
            else:
                simple.append(word)
        return pieces + _PIECE.findall(" ".join(simple).lower())

    def _learn(self, new: list[str]) -> None:
        if not new:
            return
        tokenize = self.tokenizer.model.tokenize
        found = []
        for piece in new:
            if piece[0] == " ":
                found.append(self.tokenizer.encode(piece[1:], add_special_tokens=False).ids)
            elif piece.isascii() and piece.isprintable():
                found.append([token.id for token in tokenize(piece)])
            else:
                mapped = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
                found.append([token.id for token in tokenize(mapped)])
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.held += sum(map(len, new)) + _WORD_BYTES * len(new) + flat.nbytes

    def _gather(self, words: np.ndarray) -> np.ndarray:
        lengths = self.starts[words + 1] - self.starts[words]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[words] - ends + lengths, lengths)]


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, size: int, end: int,
            keep_ids: bool = False) -> Iterator[pa.RecordBatch]:
    memory = WordIds(tokenizer)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    if keep_ids:
        names, kinds = [*names, "ids"], [*kinds, pa.list_(pa.int32())]
    for whole in batches:
        for at in range(0, whole.num_rows, _TEXTS):
            batch = whole.slice(at, _TEXTS)
            rows = []
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), memory.of(texts), strict=True):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), size)):
                    part = ids[start:start + size]
                    row = (doc, piece, start, len(part), zlib.crc32(part.tobytes()))
                    rows.append((*row, part) if keep_ids else row)
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
