"""Scalar rules on their edge cases."""

import pytest
from pyspark.sql import functions as F

from skeinwork.functions import names as N
from skeinwork.functions import periods as P
from skeinwork.functions import text as T
from skeinwork.functions import urls as U
from skeinwork.functions.infobox import infobox, infobox_text
from skeinwork.functions.records import coerce_country


def one(spark, make, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_names(spark):
    assert one(spark, N.fold_name, "  A  B\t", None, "") == ["a b", None, ""]
    assert one(spark, N.is_absent, None, " ", "N/A", "None ", "x") == [True, True, True, True, False]
    assert one(spark, N.word_count, "a b\u00a0c", "", None, " ") == [3, 0, None, 0]
    assert one(spark, N.strip_space, "\u00a0 a b\t", None) == ["a b", None]


@pytest.mark.parametrize(
    "text, year",
    [("1995-2004", 2004), ("since 1990", 1990), ("1990-present", 2030), ("inactive since 1934", 2030), ("1990s", None), ("1990s-2006", 2006), ("unknown", None), ("", None), (None, None), ("before 1699", None)],
)
def test_end_year(spark, text, year):
    assert one(spark, lambda c: P.end_year(c, 2030), text) == [year]


def test_end_year_whole_words(spark):
    assert one(spark, lambda c: P.end_year(c, 2030, whole_words=True), "inactive since 1934", "still active") == [1934, 2030]


def test_sections(spark):
    body = "One.\n\nSee also\n\nmore"
    assert one(spark, T.cut_sections, body, "One.\nReferences", "a\n Fonti \nb\nNotes\nc", None) == ["One.", "One.\nReferences", "a", None]


def test_clean(spark):
    assert one(spark, T.clean_article, "a [ 12 ]b[citation needed]  \r\n\n\n\nc \n", None, "") == ["a b\n\nc", None, ""]


def test_chunks(spark):
    text = "\n\n".join(" ".join(f"w{i}" for i in range(n)) for n in (3, 4, 2, 9, 1))
    df = spark.createDataFrame([(1, text), (2, None), (3, " \n\n "), (4, "a")], "id int, t string")
    got = [(r.id, r.chunk_no, r.n_words) for r in T.chunks(df, "id", "t", 7).orderBy("id", "chunk_no").collect()]
    assert got == [(1, 1, 7), (1, 2, 2), (1, 3, 9), (1, 4, 1), (4, 1, 1)]


def test_caps(spark):
    assert one(spark, lambda c: T.cap_words(c, 2), "a b", "a  b c", None) == ["a b", "a b\n[... article truncated ...]", None]
    assert one(spark, lambda c: T.lead(c, 2), "a b", "a b c") == [None, "a b"]


def test_mentions(spark):
    df = spark.createDataFrame([("The GANG x.\n\nNone.\n\n\nthe gang", " Gang "), ("a", " "), (None, "a")], "t string, n string")
    assert [r[0] for r in df.select(T.mentioning(F.col("t"), F.col("n"))).collect()] == ["The GANG x.\n\nthe gang", "", None]


def test_fence(spark):
    assert one(spark, T.strip_fence, '```json\n{"a": 1}\n```', '{"a": 1}') == ['{"a": 1}', '{"a": 1}']
    assert one(spark, T.rate_limited, "HTTP 429", "rate of the limit", "not found", None) == [True, True, False, False]
    assert one(spark, T.display_label, "motorcycle_club") == ["Motorcycle Club"]


def test_urls(spark):
    urls = ["https://en.wikipedia.org/wiki/A%20B_C+D#x", "https://it.wikipedia.org/w/index.php?title=X%27Y&oldid=12", "no", None, "https://en.wikipedia.org/w/index.php?oldid=99999999999999999999"]
    assert one(spark, U.language, *urls) == ["en", "it", None, None, "en"]
    assert one(spark, U.parse_title, *urls) == ["A B C+D", "X'Y", None, None, None]
    assert one(spark, U.revision, *urls) == [None, 12, None, None, None]
    assert one(spark, U.source_title, "https://x/wiki/A?b", "https://x/?title=A%ZZ", "z") == ["A", "A%ZZ", None]


def test_slug(spark):
    assert one(spark, U.slug, "A/B", "a:b?c", "__x__", "CBL / BFL", None) == ["A_B", "a_b_c", "x", "CBL_BFL", None]


def test_infobox(spark):
    html = (
        "<table class='x'></table><table class='infobox vcard'><caption>The <b>Gang</b></caption><tr><td class='subheader'>sub</td></tr>"
        "<tr><th>Founded</th><td>1990<br>in [ 3 ] Town,,</td></tr><tr><th>By</th><td><ul><li>A</li><li>B</li></ul></td></tr><tr><th></th><td>x</td></tr></table>"
    )
    want = "TheGang\nsub\nFounded: 1990, in Town\nBy: A, B"
    assert infobox_text(html) == want
    assert infobox_text(None) == infobox_text("<p>infobox</p>") == infobox_text("") == ""
    assert one(spark, infobox, html, None) == [want, ""]
    assert one(spark, lambda c: T.with_infobox(c, F.lit("k: v")), "a") == ["a\n\n--- INFOBOX ---\n\nk: v"]
    assert one(spark, lambda c: T.with_infobox(c, F.lit("")), "a") == ["a"]


def test_records(spark):
    kind = "r struct<country:string,countries_active:array<string>,confidence:string>"
    df = spark.createDataFrame([(("Brazil", ["Peru", " "], "HIGH"),), ((" ", None, "sure"),), (None,), (("Peru", ["Peru"], None),)], kind)
    got = [tuple(r[0]) for r in df.select(coerce_country(F.col("r"))).collect()]
    assert got == [("Brazil", ["Brazil", "Peru"], "high"), ("Unknown", [], "low"), ("Unknown", [], "low"), ("Peru", ["Peru"], "low")]
