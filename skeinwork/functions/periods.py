"""End year of a free-text period."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import ABSENT_WORDS, strip_space

#: Tokens for what still goes on, and the years that count.
PRESENT = ("present", "today", "current", "currently", "now", "ongoing", "active", "still active")
YEARS = r"(?U)\b(1[7-9]\d{2}|20\d{2})\b"


def end_year(period: Column, as_of_year: int, whole_words: bool = False) -> Column:
    """Latest year of a period, as_of_year where it goes on, null where it says neither.

    As in the published rule the tokens match inside words too (`inactive` goes on) and decades such as 1990s are no
    years; whole_words looks for the tokens as words only. as_of_year is a parameter, so that results can be repeated.
    """
    s = F.lower(strip_space(period))
    going = s.rlike(rf"\b(?:{'|'.join(PRESENT)})\b") if whole_words else s.rlike("|".join(PRESENT))
    years = F.transform(F.regexp_extract_all(s, F.lit(YEARS), F.lit(1)), lambda y: y.cast("int"))
    return F.when(s.isNull() | s.isin("", *ABSENT_WORDS), F.lit(None).cast("int")).when(going, F.lit(as_of_year)).otherwise(F.array_max(years))
