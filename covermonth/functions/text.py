"""String expressions shared by the policy and claims rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covermonth import schemas as S

# Fixed value: the characters with the Unicode property White_Space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The first and the last visible ASCII character.
_VISIBLE = ("!", "~")

SIGNS = ["+", "-"]


def unicode_pattern(pattern: str) -> str:
    r"""Make ``\s`` and ``\d`` cover Unicode and ``$`` mean the very end."""
    if pattern.endswith("$"):
        pattern = pattern[:-1] + r"\z"
    return "(?U)" + pattern


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends.

    ``trim`` with a character list looks at the ends only, whereas the
    equivalent regular expression is retried at every position of the text.
    It searches the whole list for each end, so texts that begin and end with
    a visible ASCII character, which are nearly all, pass without it.
    """
    last = F.substring(text, -1, 1)
    kept = text.between(*_VISIBLE) & last.between(*_VISIBLE)
    return F.when(kept, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def is_text_only(text: Column) -> Column:
    return text.rlike(unicode_pattern(S.TEXT_ONLY_PATTERN))


def is_all_digits(text: Column) -> Column:
    return text.rlike(unicode_pattern(S.ALL_DIGITS_PATTERN))


def is_integer(text: Column) -> Column:
    """True if the text fits a 64-bit integer; never NULL."""
    return text.try_cast("bigint").isNotNull()


def is_foreign_document(text: Column) -> Column:
    """True for passports and foreign residence cards."""
    found = [text.contains(mark) for mark in S.FOREIGN_DOCUMENT_MARKS]
    result = found[0]
    for other in found[1:]:
        result = result | other
    return result


def zero_fill(text: Column, width: int) -> Column:
    """Left-pad with zeros, keeping a leading sign in front of them."""
    return F.when(
        F.left(text, F.lit(1)).isin(SIGNS),
        F.concat(F.left(text, F.lit(1)), F.lpad(F.substring(text, 2, width), width - 1, "0")),
    ).otherwise(F.lpad(text, width, "0"))


def pad_document(number: Column, is_number: Column) -> Column:
    """Restore the leading zeros that spreadsheets cut from national ids."""
    short = F.length(number).isin(S.PADDED_DOCUMENT_LENGTHS)
    return F.when(short & is_number, zero_fill(number, S.DOCUMENT_LENGTH)).otherwise(number)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def drop_document_noise(text: Column) -> Column:
    """Remove punctuation from a document number, then strip it."""
    noise = unicode_pattern(S.DOCUMENT_NOISE_PATTERN)
    cleaned = F.trim(F.regexp_replace(text, noise, ""), F.lit(WHITESPACE))
    return F.when(text.rlike(noise), cleaned).otherwise(strip(text))


def last_digit(number: Column) -> Column:
    """Last character as TINYINT, NULL if it is not a digit."""
    return F.right(number, F.lit(1)).try_cast("tinyint")
