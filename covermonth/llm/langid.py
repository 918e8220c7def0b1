"""Languages of a text as a mixture, by expectation-maximisation over word likelihoods.

A language is a model of character trigrams inside words. A word's likelihood in a language is the
product of its trigrams' probabilities, so a document is a bag of words with one
likelihood per language each. Its mixture starts with the language that explains the words best; a
language joins while that raises the log-likelihood by more than a penalty, where the
proportions of each set are estimated by expectation-maximisation.

Trigrams fall into a fixed number of bins, so the model's size depends on the number of languages
only; it is broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1 << 16
SMOOTHING = 0.05
FLOOR = 1e-3  # share of a word's likelihood that any language can explain
PENALTY = 6.0  # log-likelihood that a further language has to add, and
PENALTY_PER_LOG = 1.0  # this times the logarithm of the number of words
ROUNDS = 30
UNKNOWN = "und"

_WORD = regex.compile(r"\p{L}+")  # no numerals, which \w takes for letters


@dataclass
class Model:
    """Log-probabilities of trigram bins: one row per language."""

    languages: list[str]
    log_p: np.ndarray


def train(texts: DataFrame, bins: int = BINS) -> Model:
    """Model from rows (text, lang); rows where either is null do not count.

    Every row counts. Tasks count bins per language, Spark adds the counts up; the
    driver gets at most `bins` numbers for each language.
    """
    counts = (texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
              .select(F.col("lang").cast("string").alias("lang"), "text")
              .mapInArrow(lambda batches: _count(batches, bins), "lang string, bin int, n long")
              .groupBy("lang", "bin").agg(F.sum("n").alias("n"))).toArrow()
    names = counts.column("lang").to_pylist()
    languages = sorted(set(names))
    table = np.full((len(languages), bins), SMOOTHING)
    row = {language: k for k, language in enumerate(languages)}
    place = np.fromiter((row[n] for n in names), np.int64, len(names))
    table[place, counts.column("bin").to_numpy()] += counts.column("n").to_numpy()
    table /= table.sum(axis=1, keepdims=True)
    return Model(languages, np.log(table).astype(np.float32))


def predict(text: Column, model: Model, spark) -> Column:
    """struct(lang, score, mixture): the language with the largest share of the words, that share,
    and the shares of all languages of the mixture, largest first.

    `und` with score 0 and no mixture if the text is null or has no letter, or if the
    model knows no language. Whole texts count, whatever their length.
    """
    shared = spark.sparkContext.broadcast((model.languages, model.log_p))
    kind = "struct<lang:string,score:double,mixture:array<struct<lang:string,share:double>>>"

    def languages_of(texts: pa.Array) -> pa.Array:
        languages, log_p = shared.value
        return _predict(texts, languages, log_p)

    return F.arrow_udf(languages_of, kind)(text)


def mixture(likelihood: np.ndarray, counts: np.ndarray) -> dict[int, float]:
    """Shares of the languages of one document.

    likelihood has a row for each distinct word and a column for each language, counts how often
    the word occurs.
    """
    total = counts.sum()
    scale = likelihood.max(axis=1, keepdims=True)
    p = np.exp(likelihood - scale) + FLOOR
    alone = counts @ np.log(p)
    chosen = [int(alone.argmax())]
    shares, reached = np.ones(1), float(alone.max())
    penalty = PENALTY + PENALTY_PER_LOG * np.log(total)
    while len(chosen) < p.shape[1]:
        now = p[:, chosen] @ shares
        best = None
        for k in range(p.shape[1]):
            # Log-likelihood is concave in the share of k: without a positive slope at 0, or if
            # each word took the better of both, it can't gain enough.
            ratio = p[:, k] / now
            if k in chosen or counts @ ratio <= total or (
                    counts @ np.log(np.maximum(ratio, 1)) <= penalty):
                continue
            found, value = _fit(p[:, [*chosen, k]], counts)
            if value - reached > penalty and (best is None or value > best[2]):
                best = (k, found, value)
        if best is None:
            break
        chosen, shares, reached = [*chosen, best[0]], best[1], best[2]
    return dict(zip(chosen, shares.tolist(), strict=True))


def _fit(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares by expectation-maximisation, and the log-likelihood they reach."""
    shares = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(ROUNDS):
        joint = p * shares
        new = counts @ (joint / joint.sum(axis=1, keepdims=True)) / counts.sum()
        done = np.abs(new - shares).max() < 1e-3
        shares = new
        if done:
            break
    return shares, float(counts @ np.log(p @ shares))


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _bins_of(vocabulary: list[str], bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all trigrams of the words, one space before and after each, and where each word starts."""
    joined = " " + " ".join(vocabulary) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    value = codes[:-2] * np.uint64(0x1F3D5B79) + codes[1:-1] * np.uint64(0x2545F491) * np.uint64(
        0x9E3779B1) + codes[2:] * np.uint64(0x27D4EB2F165667C5)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # As many trigrams begin in a word and the space before it as the word has letters.
    lengths = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    return ((value >> np.uint64(40)) % np.uint64(bins)).astype(np.int64), starts


def _count(batches: Iterator[pa.RecordBatch], bins: int) -> Iterator[pa.RecordBatch]:
    table: dict[str, np.ndarray] = {}
    for batch in batches:
        per_language: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(),
                              batch.column("text").to_pylist(), strict=True):
            per_language.setdefault(lang, Counter()).update(_words(text))
        for lang, words in per_language.items():
            if not words:
                continue
            found, starts = _bins_of(list(words), bins)
            times = np.fromiter(words.values(), np.int64, len(words))
            lengths = np.diff(np.append(starts, len(found) + 1)) - 1
            inside = np.ones(len(found) + 1, bool)
            inside[starts[1:] - 1] = False  # trigrams with a space in the middle
            places = found[inside[:-1]]
            counted = np.bincount(places, np.repeat(times, lengths)[:len(places)], bins)
            table.setdefault(lang, np.zeros(bins))[:] += counted
    for lang, counted in table.items():
        filled = np.flatnonzero(counted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(filled), pa.string()), pa.array(filled, pa.int32()),
             pa.array(counted[filled].astype(np.int64))], ["lang", "bin", "n"])


def _predict(texts: pa.Array, languages: list[str], log_p: np.ndarray) -> pa.Array:
    # Some documents at a time: what a task holds does not depend on Arrow's batches.
    parts = [_predict_some(texts.slice(at, 500), languages, log_p)
             for at in range(0, len(texts), 500)]
    return pa.concat_arrays(parts) if parts else _predict_some(texts, languages, log_p)


def _predict_some(texts: pa.Array, languages: list[str], log_p: np.ndarray) -> pa.Array:
    documents = [_words(text) if text else [] for text in texts.to_pylist()]
    number: dict[str, int] = {}
    ids = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
           for words in documents]
    if number and languages:
        likelihood = _likelihoods(list(number), log_p)
    out = []
    for words in ids:
        if not len(words) or not languages:
            out.append({"lang": UNKNOWN, "score": 0.0, "mixture": []})
            continue
        distinct, counts = np.unique(words, return_counts=True)
        shares = mixture(likelihood[distinct], counts.astype(float))
        ranked = sorted(((-share, languages[k]) for k, share in shares.items()))
        out.append({
            "lang": ranked[0][1], "score": min(1.0, -ranked[0][0]),
            "mixture": [{"lang": lang, "share": -share} for share, lang in ranked]})
    return pa.array(out, pa.struct([
        ("lang", pa.string()), ("score", pa.float64()),
        ("mixture", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))]))


def _likelihoods(vocabulary: list[str], log_p: np.ndarray) -> np.ndarray:
    found, starts = _bins_of(vocabulary, log_p.shape[1])
    # The trigram with a space in the middle lies between two words: it counts for none.
    values = np.zeros((len(log_p), len(found) + 1), np.float64)
    values[:, :-1] = log_p[:, found]
    values[:, starts[1:] - 1] = 0
    return np.add.reduceat(values, starts, axis=1).T
