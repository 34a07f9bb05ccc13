"""Name and text normalisers shared by the operators; every one is a column expression of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for a missing value, compared without case.
ABSENT_WORDS = ("unknown", "n/a", "none", "null")


def squeeze(c: Column) -> Column:
    """Each run of Unicode whitespace as one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def fold_name(c: Column) -> Column:
    """Squeezed and in lower case; null stays null."""
    return F.lower(squeeze(c))


def strip_space(c: Column | str) -> Column:
    """Unicode whitespace removed at both ends only."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"(?U)^\s+|\s+$", "")


def is_absent(c: Column) -> Column:
    """True for null, blank, or a word that stands for nothing; never null."""
    return F.coalesce(fold_name(c).isin("", *ABSENT_WORDS), F.lit(True))


def word_count(c: Column) -> Column:
    """Runs of characters other than Unicode whitespace; 0 for empty text, null for null."""
    return F.regexp_count(c, F.lit(r"(?U)\S+"))
