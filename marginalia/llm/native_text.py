"""Text expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space: x20 and x09-x0D.
SPACE = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is.

    ``lower`` is far faster than ``translate`` and changes nothing else where
    all other characters are lower-case letters or letters without case."""
    plain = ~text.rlike(r"[^\x00-\x7F\p{Ll}\p{Lo}]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; a null text has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def letter_words(text: Column) -> Column:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; a null text
    has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def text_hash(text: Column) -> Column:
    """A 64-bit hash of a whole text; a null is not the empty text."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text))
