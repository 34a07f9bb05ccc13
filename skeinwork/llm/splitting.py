"""Problem 1: cut oversized texts into overlapping pieces at natural boundaries.

Method: bounded-quantifier regular expressions. A text is first turned into its words, each kept with the whitespace
that follows it, and into a *mark string* with one character per word: `p` where a paragraph ends after the word, `s`
where a sentence does, `w` otherwise. One expression with alternatives ordered by boundary strength then consumes the
mark string, `{1,limit}` characters a time; as a mark is one character, the quantifier counts words, backtracking is a
plain loop without recursion, and the last alternative, any character, is the cut between words. The overlap is a
look-back of word offsets. Everything is built-in array functions, so the stage has no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import word_count

#: A gap between words ends a paragraph if it holds two line ends: then a line in it is empty or only whitespace.
_PARAGRAPH = r"(?U)\n\s*\n"
_SENTENCE = r"(?U)[.!?…。！？][\"'”’»)\]]*(?:\[\d+\])*\s+$"
_WORD = r"(?U)^\s*\S+\s*|\S+\s*"


def _alternatives(limit: int) -> str:
    """The rest if it fits; else as far as possible to a paragraph's end, a sentence's end, any word's end."""
    return f"[psw]{{1,{limit}}}$|[psw]{{0,{limit - 1}}}p|[psw]{{0,{limit - 1}}}s|[psw]{{1,{limit}}}"


def piece_pattern(max_words: int, overlap_words: int) -> str:
    """The first piece may hold max_words new words, every later one overlap_words fewer."""
    return f"^(?:{_alternatives(max_words)})|(?:{_alternatives(max_words - overlap_words)})"


def _mark(word: Column) -> Column:
    return F.when(word.rlike(_PARAGRAPH), "p").when(word.rlike(_SENTENCE), "s").otherwise("w")


def split_oversized(df: DataFrame, id_col: str, text_col: str, max_words: int = 2500, overlap_words: int = 50) -> DataFrame:
    """One row per piece of every text that holds a word.

    Columns: id_col, piece_no (from 1), n_pieces, start_word (offset of the first new word), new_words, overlap_words
    (leading words repeated from the piece before), n_words (both), boundary (what the piece ends with: paragraph,
    sentence, word, or end), paragraph_no (where the first new word stands), starts_paragraph (whether it is the first of
    it) and paragraph_words (length of that paragraph), text. The new parts of all pieces, joined, are the text up to trailing whitespace of pieces.

    Null, empty and blank texts give no row. Rows are handled one by one: repeated ids or rows give repeated pieces.
    Other columns of df are ignored, whatever their names. A single word is never cut, however long it is.
    """
    if not 0 <= overlap_words < max_words:
        raise ValueError("overlap_words must be at least 0 and less than max_words")
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # n words take 2n - 1 characters at least, so these texts fit and need no tokens
    fits = F.length("_text") <= 2 * max_words
    whole = rows.filter(fits & F.col("_text").rlike(r"(?U)\S")).select(
        F.col("_id").alias(id_col), F.lit(1).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).alias("start_word"),
        word_count(F.col("_text")).alias("new_words"), F.lit(0).alias("overlap_words"),
        word_count(F.col("_text")).alias("n_words"), F.lit("end").alias("boundary"), F.lit(1).alias("paragraph_no"), F.lit(True).alias("starts_paragraph"),
        word_count(F.split(F.regexp_replace("_text", r"(?U)^\s+", ""), _PARAGRAPH, 2)[0]).alias("paragraph_words"),
        F.regexp_replace("_text", r"(?U)\s+$", "").alias("text"),
    )
    marked = (
        rows.filter(~fits)
        .withColumn("_words", F.regexp_extract_all("_text", F.lit(_WORD), F.lit(0)))
        .drop("_text")
        .withColumn("_marks", F.array_join(F.transform("_words", _mark), ""))
        .withColumn("_paragraphs", F.transform(F.regexp_extract_all("_marks", F.lit("[sw]*p|[sw]+$"), F.lit(0)), F.length))
        .withColumn("_parts", F.regexp_extract_all("_marks", F.lit(piece_pattern(max_words, overlap_words)), F.lit(0)))
        .drop("_marks")
    )
    # places of the pieces by one running sum over their marks; then only finished pieces leave the row
    nothing = F.array().cast("array<struct<start:int,size:int,paragraph:int,begins:boolean,mark:string>>")
    begin = F.struct(F.lit(0).alias("start"), F.lit(0).alias("paragraphs"), F.lit("p").alias("mark"), nothing.alias("done"))

    def step(seen: Column, part: Column) -> Column:
        piece = F.struct(seen["start"].alias("start"), F.length(part).alias("size"), (seen["paragraphs"] + 1).alias("paragraph"), (seen["mark"] == "p").alias("begins"), F.right(part, F.lit(1)).alias("mark"))
        ends = F.length(part) - F.length(F.replace(part, F.lit("p"), F.lit("")))
        return F.struct((seen["start"] + F.length(part)).alias("start"), (seen["paragraphs"] + ends).alias("paragraphs"), piece["mark"].alias("mark"), F.concat(seen["done"], F.array(piece)).alias("done"))

    def finished(piece: Column, at: Column) -> Column:
        start, size = piece["start"], piece["size"]
        again = F.least(F.lit(overlap_words), start)
        boundary = F.when(at + 1 == F.size("_parts"), "end").when(piece["mark"] == "p", "paragraph").when(piece["mark"] == "s", "sentence").otherwise("word")
        return F.struct(
            (at + 1).alias("piece_no"), F.size("_parts").alias("n_pieces"), start.alias("start_word"), size.alias("new_words"), again.alias("overlap_words"), (size + again).alias("n_words"),
            boundary.alias("boundary"), piece["paragraph"].alias("paragraph_no"), piece["begins"].alias("starts_paragraph"), F.element_at("_paragraphs", piece["paragraph"]).alias("paragraph_words"),
            F.regexp_replace(F.array_join(F.slice("_words", start - again + 1, again + size), ""), r"(?U)\s+$", "").alias("text"),
        )

    placed = F.aggregate("_parts", begin, step, lambda seen: seen["done"])
    cut = marked.withColumn("_pieces", placed).select(F.col("_id").alias(id_col), F.inline(F.transform("_pieces", finished)))
    return whole.unionByName(cut)


def oversized_found(pieces: DataFrame, id_col: str, max_words: int = 2500) -> DataFrame:
    """(id, 0) for every text that was cut, and (id, k) for every paragraph k that alone exceeds the limit.

    Such a paragraph always starts a piece: the cut before it is at a paragraph's end, which beats every other.
    """
    found = F.array(
        F.when(F.col("piece_no") == 1, F.lit(0)),
        F.when(F.col("starts_paragraph") & (F.col("paragraph_words") > max_words), F.col("paragraph_no")),
    )
    return pieces.filter("n_pieces > 1").select(id_col, F.explode(F.filter(found, lambda k: k.isNotNull())).alias("paragraph_no"))
