"""Quality rules as a ledger of bits.

Every text is measured once and every rule is evaluated once. A row keeps its measurements and
one long whose bits say which rules it fails. A policy is a mask over these bits with a version, so a new
policy, or leaving one rule out, needs no text again: it is a bitwise AND. Ablations aggregate
over the distinct bit patterns, of which there are at most 2 to the number of rules.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_letter_words", "n_top_word", "n_letters", "n_upper", "n_exclaims", "longest_word",
]


def _share_over(part: str, whole: str, percent: int) -> Column:
    return 100 * F.col(part) > percent * F.col(whole)


# Failing condition of each rule; the place in the list is its bit. New rules go to the end: a
# bit never changes its meaning.
def rules() -> dict[str, Column]:
    return {
        "few_words": F.col("n_words") < 50,
        "repeated_words": _share_over("n_repeat_words", "n_words", 50),
        "symbols": _share_over("n_symbols", "n_words", 10),
        "repeated_lines": _share_over("n_dup_lines", "n_lines", 50),
        "words_without_letters": 100 * F.col("n_letter_words") < 60 * F.col("n_words"),
        "short_words": 10 * F.col("word_chars") < 25 * F.col("n_words"),
        "long_words": F.col("word_chars") > 12 * F.col("n_words"),
        "one_word_dominates": _share_over("n_top_word", "n_words", 30),
        "shouting": _share_over("n_upper", "n_letters", 50),
        "exclamations": _share_over("n_exclaims", "n_words", 20),
        "unbroken_run": F.col("longest_word") > 1000,
    }


RULES = [
    "few_words", "repeated_words", "symbols", "repeated_lines", "words_without_letters",
    "short_words", "long_words", "one_word_dominates", "shouting", "exclamations",
    "unbroken_run",
]
BASE_POLICY = "base-1"
POLICIES: dict[str, list[str]] = {
    BASE_POLICY: ["few_words", "repeated_words"],
    "prose-1": RULES[:8],
    "prose-2": RULES,
}


def policy_mask(version: str) -> int:
    return sum(1 << RULES.index(name) for name in POLICIES[version])


def ledger(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with every measurement and `failed_bits` in one row for each row of docs.

    Words are runs of characters other than ASCII white space. A null text is measured as an
    empty one: all zeros, so it fails few_words alone. Repeated rows, and rows without doc_id,
    are measured like any. Other columns are ignored.
    """
    kind = StructType([StructField(name, LongType()) for name in MEASURES])
    measure = F.arrow_udf(_measure, kind)
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), measure(F.col("text")).alias("m"),
    ).select("doc_id", "m.*")
    bits = F.lit(0).cast("long")
    conditions = rules()
    for place, name in enumerate(RULES):
        bit = F.when(conditions[name], F.lit(1 << place)).otherwise(F.lit(0)).cast("long")
        bits = bits.bitwiseOR(bit)
    return measured.withColumn("failed_bits", bits)


def apply_policy(rows: DataFrame, version: str, column: str = "kept") -> DataFrame:
    """Rows of a ledger with the verdict of a policy: kept if none of its rules fails."""
    mask = F.lit(policy_mask(version)).cast("long")
    return rows.withColumn(column, F.col("failed_bits").bitwiseAND(mask) == 0)


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: the rows that fail it, those that fail it alone (what
    leaving it out would keep), and the rows kept with and without it."""
    patterns = rows.groupBy("failed_bits").count()
    mask = policy_mask(version)
    names = POLICIES[version]
    table = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(1 << RULES.index(n)).cast("long").alias("bit"))
        for n in names])).alias("r")
    failed = F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("count"))), F.lit(0).cast("long"))

    return (patterns.select("count", failed.alias("failed"), table)
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(total(F.col("failed").bitwiseAND(F.col("r.bit")) != 0).alias("failing"),
                 total(F.col("failed") == F.col("r.bit")).alias("failing_alone"),
                 total(F.col("failed") == 0).alias("kept"))
            .withColumn("kept_without", F.col("kept") + F.col("failing_alone"))
            .withColumn("policy", F.lit(version)))


def compare_policies(rows: DataFrame, versions: Mapping[str, list[str]] = POLICIES) -> DataFrame:
    """Rows kept by each version of the policy, from the bit patterns alone."""
    patterns = rows.groupBy("failed_bits").count()
    masks = F.explode(F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(policy_mask(v)).cast("long").alias("mask"))
        for v in versions])).alias("p")
    passing = F.col("failed_bits").bitwiseAND(F.col("p.mask")) == 0
    return patterns.select("count", "failed_bits", masks).groupBy(
        F.col("p.policy").alias("policy")).agg(
        F.coalesce(F.sum(F.when(passing, F.col("count"))), F.lit(0).cast("long")).alias("kept"),
        F.sum("count").alias("rows"))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, window, times = np.unique(
        pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:k + len(again)] |= again
    return int(covered.sum())


def _measure(texts: pa.Array) -> pa.Array:
    columns: list[list[int]] = [[] for _ in MEASURES]
    for text in texts.to_pylist():
        for column, value in zip(columns, measures(text or ""), strict=True):
            column.append(value)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], MEASURES)


def measures(text: str) -> tuple[int, ...]:
    """Values of MEASURES for one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    lines = repeated = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                repeated += 1
            seen.add(line)
    counts = Counter(words)
    with_letter = letters = upper = longest = 0
    for word, n in counts.items():
        if word.isalpha() and word.islower():  # ASCII letters
            with_letter += n
            letters += n * len(word)
            longest = max(longest, len(word))
            continue
        decoded = word.decode("utf-8", "surrogatepass")
        alphabetic = sum(map(str.isalpha, decoded))
        with_letter += n * (alphabetic > 0)
        letters += n * alphabetic
        upper += n * sum(c.isupper() and c.isalpha() for c in decoded)
        longest = max(longest, len(decoded))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeated,
        repeated_words(words),
        lines,
        with_letter,
        max(counts.values(), default=0),
        letters,
        upper,
        text.count("!"),
        longest,
    )
