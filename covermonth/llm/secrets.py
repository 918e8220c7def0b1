"""Secrets in texts: fixed patterns, and credential values that are hard to guess.

Patterns find assignments, access keys and long hexadecimal runs. Values that stand where a
credential stands are also priced: a dynamic program splits the value into words, dates,
repeats, keyboard walks, sequences and brute-force spans such that the number of guesses is
smallest. A value that is cheap to guess is a placeholder; one that is not is a secret.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
SPAN = "array<struct<kind:string,start:int,end:int,cost:double>>"
LEAST_COST = 10.0  # a secret takes 10 to this many guesses
MASK = "[secret]"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal: shorter ones would be dropped

# Where a credential stands: a name for it, at the beginning of a word or of a part of a compound, a
# sign or word that gives it a value, the value. Without quotes it goes on to the next white space, end
# tag or further assignment.
CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))"""
    r"""(?i:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private|auth|secret|client)[_-]?key|authorization|bearer)"""
    r"""["']?\s{0,5}+[\x20\t]*+(=>|:=|[:=]|(?<=\s)(?:is|was)\s)\s{0,4}+[\x20\t]*+(?:bearer\s{1,4}+[\x20\t]*+)?"""
    r"""(?:"([^"\n]{6,})"|'([^'\n]{6,})'|(?!["'`<])((?:(?!</)\S){6}(?:(?!</[a-z]|<br|[,;]["']?[a-z_][\w.-]{0,40}["']?[:=])\S)*+)))""",
    re.ASCII)
# What prose says of a secret: a word as prose writes words.
PROSE = re.compile(r"[^\W\d_]?[^\W\d_A-Z]+|[A-Z]+")

_CLOSING = ",;:.)]}>\"'`"

# Passwords and placeholders in the order in which a guesser tries them.
WORDS = [
    "password", "123456", "qwerty", "admin", "welcome", "letmein", "changeme", "secret",
    "default", "example", "test", "token", "login", "master", "dragon", "monkey", "iloveyou",
    "football", "baseball", "sunshine", "princess", "shadow", "superman", "batman", "trustno",
    "hello", "freedom", "whatever", "starwars", "passw", "pass", "root", "user", "guest", "demo",
    "sample", "dummy", "placeholder", "none", "null", "undefined", "true", "false", "your",
    "here", "insert", "replace", "enter", "value", "string", "todo", "foo", "bar", "baz", "key",
    "api", "access", "private", "public", "client", "server", "service", "system", "database",
    "mysql", "postgres", "redis", "oracle", "summer", "winter", "spring", "autumn", "monday",
    "friday", "january", "december", "love", "money", "computer", "internet", "office", "company",
    "hidden", "redacted", "masked", "removed", "config", "settings", "environ", "process", "self",
    "this", "that", "the", "and", "my", "is", "not", "with", "from", "for", "new", "old",
]
KEYBOARD = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"]
LEET = {"@": "a", "4": "a", "8": "b", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s",
        "7": "t", "2": "z"}

_RANK = {word: place for place, word in enumerate(WORDS, 1)}
_LONGEST = max(map(len, WORDS))
_PLACE = {c: (x + y / 2, y) for y, row in enumerate(KEYBOARD) for x, c in enumerate(row)}
_DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
    r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d", re.ASCII)
_YEAR = re.compile(r"(?:19|20)\d\d", re.ASCII)
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def find_secrets(text: Column) -> Column:
    """Spans of one text, by start, then kind: array of (kind, start, end, cost).

    Places are code points, end exclusive. Spans of a kind do not overlap. `guess` spans are
    values in a credential's place that no `assign` span covers; cost is the decimal
    logarithm of the guesses, null for other kinds. Null and empty texts have none; any
    length is searched whole.
    """
    return F.arrow_udf(_find, SPAN)(text)


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The same rows and columns, secrets in text replaced by [secret]; n_chars, if there, follows.

    Texts without secrets, nulls among them, stay as they are, with their n_chars.
    """
    masked = F.arrow_udf(_mask, "string")(F.col("text"))
    if "n_chars" not in docs.columns:
        return docs.withColumn("text", masked)
    name, new = "n_chars", "masked_text"
    while new.lower() in {c.lower() for c in docs.columns}:
        new += "_"
    kind = docs.schema[name].dataType
    changed = docs.select(*docs.columns, masked.alias(new))
    same = F.col(new).eqNullSafe(F.col("text"))
    return changed.select(*[
        F.col(new).alias("text") if c == "text"
        else F.when(same, F.col(c)).otherwise(F.length(new).cast(kind)).alias(c)
        if c == name else F.col(c)
        for c in docs.columns])


def spans_of(text: str) -> list[tuple[str, int, int, float | None]]:
    found = [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span(), None) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
    covered = [(start, end) for kind, start, end, _ in found if kind == "assign"]
    for m in CONTEXT.finditer(text):
        group = next(g for g in (2, 3, 4) if m[g] is not None)
        start, end = m.span(group)
        if group == 4:
            if m[4][0] == "(" and m[4].rstrip(",;:.").endswith(")"):
                continue  # a remark in place of a value
            end = start + len(m[4].rstrip(_CLOSING))
            if end - start < 6:
                continue
            if m[1].strip() in (":", "is", "was", "IS", "WAS", "Is", "Was") and all(
                    PROSE.fullmatch(part) for part in re.split("[-'’]", text[start:end]) if part):
                continue
        if any(a < end and start < b for a, b in covered):
            continue
        cost = guess_cost(text[start:end])
        if cost >= LEAST_COST:
            found.append(("guess", start, end, cost))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def guess_cost(value: str) -> float:
    """Decimal logarithm of the guesses that the cheapest segmentation of a value takes."""
    each = _brute(value)
    least = [0.0] * (len(value) + 1)
    pieces = _pieces(value)
    for end in range(1, len(value) + 1):
        best = least[end - 1] + each[end - 1]
        for start, cost in pieces.get(end, ()):
            # A boundary between kinds of segments costs a guess where it lies.
            best = min(best, least[start] + cost + (0.3 if start else 0.0))
        least[end] = best
    return least[-1]


def _brute(value: str) -> list[float]:
    if _HEX_ONLY.fullmatch(value):
        return [math.log10(16)] * len(value)
    return [math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33) for c in value]


def _pieces(value: str) -> dict[int, list[tuple[int, float]]]:
    """Segments other than brute force, by their end: (start, cost)."""
    out: dict[int, list[tuple[int, float]]] = {}
    lower = value.lower()
    if len(lower) != len(value):  # a character whose lower case is longer
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = "".join(LEET.get(c, c) for c in lower)

    def add(start: int, end: int, cost: float) -> None:
        out.setdefault(end, []).append((start, cost))

    for start in range(len(value)):
        for end in range(start + 2, min(len(value), start + _LONGEST) + 1):
            for word, extra in ((lower[start:end], 0.0), (plain[start:end], 0.6)):
                if word in _RANK:
                    case = 0.0 if value[start:end] == lower[start:end] else 0.3
                    add(start, end, math.log10(_RANK[word]) + case + extra)
                    break
    for pattern, cost in ((_DATE, math.log10(365 * 130 * 4)), (_YEAR, math.log10(130))):
        for start in range(len(value)):
            if m := pattern.match(value, start):
                add(start, m.end(), cost)
    for start, end, cost in _runs(lower):
        # A part of a run is a run.
        for stop in range(start + 3, end + 1):
            add(start, stop, cost + math.log10(stop - start))
    return out


def _runs(lower: str) -> Iterable[tuple[int, int, float]]:
    """Repeats of a character or a block, alphabet and digit sequences, keyboard walks."""
    n = len(lower)
    for kind in ("repeat", "sequence", "walk"):
        start = 0
        while start < n - 2:
            end, turns, last = start + 1, 0, None
            while end < n:
                a, b = lower[end - 1], lower[end]
                if kind == "repeat":
                    step = 0 if a == b else None
                elif kind == "sequence":
                    step = ord(b) - ord(a) if a.isalnum() and b.isalnum() else None
                    step = step if step in (1, -1) and (last is None or step == last) else None
                else:
                    step = _step(a, b)
                if step is None:
                    break
                turns += last is not None and step != last
                last = step
                end += 1
            if end - start >= 3:
                cost = {"repeat": 1.5, "sequence": 1.2, "walk": math.log10(47)}[kind]
                yield start, end, cost + (0.9 * turns if kind == "walk" else 0.0)
            start = max(start + 1, end - 1)
    for m in re.finditer(r"(.{2,8}?)\1+", lower):
        yield m.start(), m.end(), sum(_brute(m[1]))


def _step(a: str, b: str) -> tuple[float, int] | None:
    if a not in _PLACE or b not in _PLACE or a == b:
        return None
    dx, dy = _PLACE[b][0] - _PLACE[a][0], _PLACE[b][1] - _PLACE[a][1]
    return (dx, dy) if abs(dx) <= 1 and abs(dy) <= 1 else None


def _find(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32()), ("cost", pa.float64())]))
    return pa.array(
        [[dict(zip(("kind", "start", "end", "cost"), s, strict=True)) for s in spans_of(text or "")]
         for text in texts.to_pylist()], kind)


def _mask(texts: pa.Array) -> pa.Array:
    out = []
    for text in texts.to_pylist():
        parts, at = [], 0
        spans = spans_of(text or "")
        for _, start, end, _ in spans:
            if start >= at:
                parts += [text[at:start], MASK]
            at = max(at, end)
        out.append("".join(parts) + text[at:] if spans else text)
    return pa.array(out, pa.string())
