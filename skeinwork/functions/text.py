"""Text rules for article bodies: cleaning, paragraphs, chunks, caps, and passages that mention a name."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import strip_space, word_count

#: Headings from which the rest of an article is cut, English and Italian.
CUT_HEADINGS = (
    "See also", "References", "Notes", "Notes and references", "Further reading", "External links", "Bibliography", "Sources",
    "Footnotes", "Learn more", "Voci correlate", "Note", "Bibliografia", "Collegamenti esterni", "Fonti",
)
#: Citation marks that survive in plain text.
CITATIONS = r"\[\s*\d+\s*\]|\[\s*senza fonte\s*\]|\[\s*citazione necessaria\s*\]|\[\s*citation needed\s*\]"
#: Line ends of the plain-text rule, beyond LF: CR LF, CR, VT, FF, FS, GS, RS, NEL, LS, PS.
_LINE_ENDS = r"\r\n|[\r\x0B\x0C\x1C\x1D\x1E\u0085  ]"


def cut_sections(text: Column, headings: tuple[str, ...] = CUT_HEADINGS) -> Column:
    """Everything from the first listed heading that has a line of its own and a line after it."""
    return F.regexp_replace(text, rf"(?isU)\n\s*(?:{'|'.join(headings)})\s*\n.*", "")


def strip_citations(text: Column) -> Column:
    return F.regexp_replace(text, CITATIONS, "")


def tidy_lines(text: Column) -> Column:
    """No whitespace at line ends, at most one blank line in a row, trimmed."""
    text = F.regexp_replace(text, _LINE_ENDS, "\n")
    text = F.regexp_replace(text, r"(?U)[^\S\n]+(?=\n|$)", "")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_article(text: Column) -> Column:
    """Sections cut, citation marks removed, lines tidied, in that order."""
    return tidy_lines(strip_citations(cut_sections(text)))


def with_infobox(text: Column, box: Column, marker: str = "--- INFOBOX ---") -> Column:
    """The text, and after a marker line the infobox if it has one."""
    return F.when(F.length(box) > 0, F.concat(text, F.lit(f"\n\n{marker}\n\n"), box)).otherwise(text)


def paragraphs(text: Column) -> Column:
    """Array of stripped paragraphs that are not blank; two or more line feeds in a row part them."""
    parts = F.transform(F.split(text, r"\n{2,}"), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))
    return F.filter(parts, lambda p: p != "")


def first_words(text: Column, n: int) -> Column:
    """The first n words, single spaces between."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0)), 1, n), " ")


def cap_words(text: Column, n: int = 8000, mark: str = "\n[... article truncated ...]") -> Column:
    """The text itself if it has at most n words, else its first n words and a mark."""
    return F.when(word_count(text) <= n, text).otherwise(F.concat(first_words(text, n), F.lit(mark)))


def mentioning(text: Column, name: Column) -> Column:
    """The paragraphs that hold a name, whatever its case, with a blank line between; empty if none or the name is blank."""
    wanted = F.lower(strip_space(name))
    return F.when(wanted != "", F.array_join(F.filter(F.split(text, r"\n{2,}"), lambda p: F.contains(F.lower(p), wanted)), "\n\n")).otherwise(F.lit(""))


def chunks(df: DataFrame, id_col: str, text_col: str, max_words: int = 2500) -> DataFrame:
    """(id, chunk_no, n_words, text): paragraphs packed greedily into chunks of at most max_words words.

    A paragraph over the limit closes the open chunk and is one of its own. Blank and null texts give no row. The sum that
    starts anew depends on what came before, so no window expresses it; texts go to Python in Arrow batches, one pass
    each, and memory is bounded by one batch.
    """
    parts = df.select(F.col(id_col).alias("_id"), paragraphs(F.col(text_col)).alias("_p")).filter(F.size("_p") > 0)
    sized = parts.withColumn("_n", F.transform("_p", word_count))
    kind = sized.schema["_id"].dataType.simpleString()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, texts, sizes in zip(batch["_id"], batch["_p"], batch["_n"]):
                held, total, number = [], 0, 0
                for text, size in zip(texts, sizes):
                    if held and total + size > max_words:
                        number += 1
                        out.append((key, number, total, "\n\n".join(held)))
                        held, total = [], 0
                    held.append(text)
                    total += int(size)
                out.append((key, number + 1, total, "\n\n".join(held)))
            yield pd.DataFrame(out, columns=["_id", "chunk_no", "n_words", "text"])

    return sized.mapInPandas(pack, f"_id {kind}, chunk_no int, n_words int, text string").withColumnRenamed("_id", id_col)


def lead(text: Column, n: int = 300) -> Column:
    """The first n words of a text that has more, else null; given to every chunk of an article of several chunks."""
    return F.when(word_count(text) > n, first_words(text, n))


def strip_fence(text: Column) -> Column:
    """JSON out of a fenced block, if it is in one."""
    return strip_space(F.regexp_replace(strip_space(text), r"^```(?:json)?\s*|\s*```$", ""))


def display_label(c: Column) -> Column:
    """Words of an identifier with capitals."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def rate_limited(message: Column) -> Column:
    """Whether an error message tells of a rate limit."""
    return F.coalesce(message.rlike(r"(?i)\b429\b|too many requests|ratelimit|rate.*limit"), F.lit(False))
