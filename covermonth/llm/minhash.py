"""Near duplicates by b-bit MinHash.

Texts with equal shingle sets form a class at once, by a digest of the set, so copies
never meet as pairs. Each class has one signature: the minima of `bands * rows` hash
functions over its shingles. Two classes are candidates where all minima of a band
agree. Of a minimum only the lowest two bits are kept beside the band keys; the packed bits estimate the
similarity of a candidate pair by counting equal bit pairs, corrected for the quarter
that agrees by chance. What the estimate leaves is confirmed on the full sets.

A band bucket can hold a very large group of near copies. No pairs are made
inside it: every class is first compared with one other class of its buckets, the hub that its bits
say is most like it, and links are joined to components. Most buckets then lie within one component. In
the others every pair of classes of different components is compared, in blocks of bounded size,
which give back a spanning set of their links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covermonth.llm.components import components
from covermonth.llm.filters import bitmap, possible
from covermonth.llm.scratch import Scratch
from covermonth.llm.words import WordHashes, lists, mix, shingles, words

BITS = 2
BANDS = 32
ROWS = 5  # A pair of similarity 0.8 shares a band with probability 0.999997.
BLOCK = 512  # classes of a bucket that are compared with as many others at a time
SLACK = 0.2  # six standard deviations of the estimate

_LOW = 0x5555555555555555


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, threshold: Fraction = Fraction(4, 5),
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text).

    Two texts are linked if their sets of `shingle_words`-word shingles have a Jaccard
    similarity of at least `threshold`; component_id is the smallest doc_id reachable over links, and
    kept says that it is the row's own. Texts that are null, empty or without words have 0
    shingles and are linked with nothing: their component is their own doc_id. Texts of
    fewer words are one shingle. Repeated rows are linked as equal texts and share their
    values; rows without doc_id count for links, and are kept only if the whole component has none.
    Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.save(
        texts.mapInArrow(lambda batches: _sign(batches, shingle_words),
                         "doc_id long, n long, node binary, sig array<long>, bands array<long>"),
        "signed")
    # Rows of a class have the same signature: any will do.
    classes = scratch.save(
        signed.where("n > 0").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
            F.first("sig").alias("sig"), F.first("bands").alias("bands")),
        "classes")

    banded = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = scratch.save(banded.join(shared, "bucket"), "members")

    sets = scratch.save(_sets_of(texts, members, classes, shingle_words), "sets")

    near = _likely(_hub_pairs(members), classes, threshold)
    best = near.groupBy("node").agg(F.max_by("hub", "estimate").alias("hub"))
    links = scratch.save(_confirmed(best, sets, threshold), "links-hub")
    roots = components(links, scratch, "hubs")

    rest = scratch.save(_unsettled(members, roots), "unsettled")
    more = (rest.join(classes.select("node", "sig", "bands"), "node").join(sets, "node")
            .groupBy("bucket", "i", "j")
            .applyInPandas(lambda block: _block_links(block, threshold), "a binary, b binary"))
    links = scratch.save(
        roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more), "links-all")
    roots = components(links, scratch, "all")

    groups = classes.select("node", "doc_id").join(roots, "node", "left")
    groups = groups.withColumn("root", F.coalesce("root", "node"))
    least = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = groups.join(least, "root").select("node", "component_id")
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("node")).alias("node"))
        .join(found, "node", "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("n_shingles") > 0, F.col("component_id"))
                .otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _hashed(batch: pa.RecordBatch, memory: WordHashes, size: int) -> list[np.ndarray]:
    return [shingles(memory.of(words(text)), size) for text in batch.column("text").to_pylist()]


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _offsets(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    memory = WordHashes()
    count = BANDS * ROWS
    seeds = mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    factors, shift = seeds | np.uint64(1), mix(seeds)
    per_word = 64 // BITS
    for whole in batches:
        # Texts of a batch can be long: some rows at a time.
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            sets = _hashed(batch, memory, size)
            offsets = _offsets(sets)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            filled = np.flatnonzero(np.diff(offsets))
            minima = np.zeros((count, len(sets)), np.uint64)
            if len(filled):
                for p in range(count):
                    value = (flat * factors[p] + shift[p]) >> np.uint64(32)
                    minima[p, filled] = np.minimum.reduceat(value, offsets[filled])
            keys = np.zeros((BANDS, len(sets)), np.uint64)
            for band in range(BANDS):
                for row in range(ROWS):
                    keys[band] = mix(keys[band] * np.uint64(3) + minima[band * ROWS + row]
                                     + np.uint64(band + 1))
            low = minima & np.uint64((1 << BITS) - 1)
            sig = np.zeros((count // per_word, len(sets)), np.uint64)
            for p in range(count):
                sig[p // per_word] |= low[p] << np.uint64(BITS * (p % per_word))
            rows = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    lists(sig.T.ravel(), np.arange(rows + 1) * len(sig)),
                    lists(keys.T.ravel(), np.arange(rows + 1) * BANDS),
                ],
                ["doc_id", "n", "node", "sig", "bands"],
            )


def _sets_of(
    texts: DataFrame, members: DataFrame, classes: DataFrame, size: int,
) -> DataFrame:
    """The full set of every class that shares a bucket, from one of its rows."""
    ids = members.select("node").distinct().join(classes.select("node", "doc_id"), "node")
    known = texts.sparkSession.sparkContext.broadcast(bitmap(ids, "doc_id"))
    found = texts.mapInArrow(lambda batches: _sets(batches, known, size),
                             "node binary, doc_id long, shingles array<long>")
    same = (F.col("x.node") == F.col("y.node")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id"))
    return (found.alias("x").join(ids.alias("y"), same, "left_semi")
            .dropDuplicates(["node"]).select("node", "shingles"))


def _sets(batches: Iterator[pa.RecordBatch], known, size: int) -> Iterator[pa.RecordBatch]:
    memory = WordHashes()
    for whole in batches:
        ids = whole.column("doc_id").to_numpy(zero_copy_only=False)
        wanted = np.array(whole.column("doc_id").is_null()) | possible(
            known.value, np.nan_to_num(ids).astype(np.int64))
        whole = whole.filter(pa.array(wanted))
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            sets = _hashed(batch, memory, size)
            flat = np.concatenate(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), batch.column("doc_id"),
                 lists(flat, _offsets(sets))],
                ["node", "doc_id", "shingles"],
            )


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Each class with the hubs of its buckets. The hub of a bucket is its class that shares
    most places with others: of many copies of one text, that is the text itself."""
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (members.join(weight, "node").groupBy("bucket")
            .agg(F.max(F.struct("weight", "node")).alias("most"))
            .select("bucket", F.col("most.node").alias("hub")))
    return (members.join(hubs, "bucket").where(F.col("node") != F.col("hub"))
            .select("node", "hub").distinct())


def _estimate(left: Column, right: Column) -> Column:
    """Similarity from the packed bits of two signatures."""
    words = BANDS * ROWS * BITS // 64
    differing = F.lit(0)
    for i in range(words):
        x = left[i].bitwiseXOR(right[i])
        differing += F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LOW)))
    chance = 1 / 2**BITS
    return (1 - differing / (BANDS * ROWS) - chance) / (1 - chance)


def _likely(pairs: DataFrame, classes: DataFrame, threshold: Fraction) -> DataFrame:
    sig = classes.select("node", "sig")
    return (pairs.join(sig, "node")
            .join(sig.select(F.col("node").alias("hub"), F.col("sig").alias("hub_sig")), "hub")
            .select("node", "hub", _estimate(F.col("sig"), F.col("hub_sig")).alias("estimate"))
            .where(F.col("estimate") >= float(threshold) - SLACK))


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    both = (pairs.join(sets, "node")
            .join(sets.select(F.col("node").alias("hub"), F.col("shingles").alias("other")), "hub")
            .select("node", "hub", F.size("shingles").alias("n"), F.size("other").alias("m"),
                    F.size(F.array_intersect("shingles", "other")).cast("long").alias("common")))
    union = F.col("n") + F.col("m") - F.col("common")
    return both.where(
        threshold.denominator * F.col("common") >= threshold.numerator * union
    ).select(F.col("node").alias("a"), F.col("hub").alias("b"))


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, dealt to pairs of blocks.

    Of buckets with the same members, that of the first band is enough.
    """
    now = (members.join(roots, "node", "left")
           .select("bucket", "band", "node", F.coalesce("root", "node").alias("root")))
    hashed = F.xxhash64("node"), F.xxhash64("node", F.lit(5))
    buckets = (now.groupBy("bucket", "band", "root")
               .agg(F.count("*").alias("n"), F.bit_xor(hashed[0]).alias("x"),
                    F.bit_xor(hashed[1]).alias("y"))
               .groupBy("bucket", "band")
               .agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("largest"),
                    F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
               .where(F.col("largest.n") < F.col("size"))
               .groupBy("size", "x", "y").agg(
                   F.min_by(F.struct("bucket", "largest"), "band").alias("first"))
               .select("first.bucket", F.col("first.largest.root").alias("largest"),
                       *_block_counts(F.col("size"), F.col("first.largest.n"))))
    inner = (F.col("root") == F.col("largest")) & (F.col("inner") > 0)
    place = F.xxhash64("node", F.lit(3))
    own = F.when(inner, F.col("outer") + F.pmod(place, F.greatest("inner", F.lit(1)))).otherwise(
        F.pmod(place, F.col("outer"))).cast("int")
    last = F.when(inner, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1
    return (now.join(buckets, "bucket").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
            .select("bucket", "band", "node", "root", "own", F.least("own", "other").alias("i"),
                    F.greatest("own", "other").alias("j")))


def _block_counts(size: Column, largest: Column) -> list[Column]:
    """Blocks of a bucket's classes outside its largest component, and inside it: no two of
    these need to be compared. A small bucket is one block."""
    small = size <= BLOCK
    return [
        F.when(small, 1).otherwise(F.ceil((size - largest) / BLOCK)).alias("outer"),
        F.when(small, 0).otherwise(F.ceil(largest / BLOCK)).alias("inner"),
    ]


def _block_links(block: pd.DataFrame, threshold: Fraction) -> pd.DataFrame:
    """A spanning set of the links between components inside a block.

    Two classes that share several buckets are compared in that of their first common band only.
    """
    nodes, sets = block["node"].tolist(), block["shingles"].tolist()
    sig = np.stack([np.asarray(s, np.int64).view(np.uint64) for s in block["sig"]])
    bands = np.stack([np.asarray(b) for b in block["bands"]])
    band = block["band"].iloc[0]
    own = block["own"].to_numpy()
    across = block["i"].iloc[0] != block["j"].iloc[0]
    _, root = np.unique(block["root"].to_numpy(), return_inverse=True)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    chance = 1 / 2**BITS
    found = []
    for k in range(len(nodes) - 1):
        x = sig[k] ^ sig[k + 1:]
        differing = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_LOW)).sum(axis=1)
        estimate = (1 - differing / (BANDS * ROWS) - chance) / (1 - chance)
        rest = k + 1 + np.flatnonzero(estimate >= float(threshold) - SLACK)
        rest = rest[root[rest] != root[k]]
        if across:  # each block is compared with itself elsewhere
            rest = rest[own[rest] != own[k]]
        rest = rest[(bands[rest] == bands[k]).argmax(axis=1) == band]
        if not len(rest):
            continue
        chosen = np.isin(owner, rest)
        hit = owner[chosen][np.isin(flat[chosen], sets[k])]
        common = np.bincount(hit, minlength=len(nodes))[rest]
        union = size[k] + size[rest] - common
        for other in rest[threshold.denominator * common >= threshold.numerator * union]:
            if root[other] != root[k]:
                found.append((nodes[k], nodes[other]))
                root[root == root[other]] = root[k]
    return pd.DataFrame(found, columns=["a", "b"])
