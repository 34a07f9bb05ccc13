import datetime as dt

import pytest
from pyspark.sql import functions as F

from skeinwork.llm.survivors import Field, edge_survivors, end_year, survive, survivors_found

EDGE = "edge_id bigint, source string, target string, relationship string, context string, time_period string, evidence string, merged_at timestamp, group_id string, n_rows int"
T0 = dt.datetime(2024, 1, 1)


def edge(i, s, t, rel=None, ctx=None, tp=None, ev=None, day=0):
    return (i, s, t, rel, ctx, tp, ev, None if day is None else T0 + dt.timedelta(days=day), "clash", 1)


@pytest.mark.parametrize(
    "text, year",
    [
        ("1990-1995", 1995), ("1990s", 1999), ("early 1990s-mid-2000s", 2009), ("1990s-1991", 1999), ("since 1990", 9999), ("1990-present", 9999), ("1911 to the present day", 9999), ("inactive since 1934", 1934),
        ("defunct since 2001", 2001), ("1926; dissolved 1953", 1953), ("until 1923", 1923), ("1890-06-17 to 1910-07-25", 1910), ("1995-?", 9999), ("1990–", 9999), ("several decades ago", None), ("present", None),
        ("unknown", None), (None, None), ("", None), ("2003, 2004 and 2020", 2020), ("c. 1940", 1940), ("12345", None), ("still active in 1980", 9999), ("1990 until now", 9999), ("active until 1990", 1990), ("from 1990 through the present", 9999), ("1985–95", 1995), ("2003-10", 2003), ("1990-06-17", 1990), ("from 1970s", 9999),
    ],
)
def test_end_year(spark, text, year):
    assert spark.createDataFrame([(text,)], "t string").select(end_year(F.col("t"))).first()[0] == year


def test_fields(spark):
    rows = [
        edge(3, "A", "b", " Alliance", "long enough", "1990", "own_source", 1), edge(2, "B ", "a", "rivalry", "longer text   ", "1990", "own_source", 2), edge(5, "a", "B", "other", "N/A", "1989", None, None),
        edge(9, "a", "b", "partners", None, "unknown", "own_source", 9), edge(1, "a", "a", "other"), edge(4, None, "b"), edge(6, " ", "b"), edge(7, "x", "y", None, "none", "tbd"), edge(8, "y", "X"), edge(10, "p", "q", "other", "c", "1999"),
    ]
    for n in (1, 4):
        got = edge_survivors(spark.createDataFrame(rows, EDGE).repartition(n))
        found = sorted(tuple(r) for r in survivors_found(got).collect())
        assert found == [(2, 2, 2, 2), (7, 0, 0, 0)]
    full = got.filter("group_id = 2").first()
    assert (full.time_period, full.context, full.relationship, full.n_rows) == ("1990", "longer text", "rivalry", 4)
    assert edge_survivors(spark.createDataFrame([], EDGE)).count() == 0


def test_hot_group_and_repeats(spark):
    df = spark.range(30_000).select(F.col("id").alias("i"), F.lit("k").alias("k"), (F.col("id") % 100).cast("string").alias("v"))
    df = df.union(df.limit(10))
    r = survive(df, ["k"], "i", [Field("v", F.col("v"), F.col("v") != "99", (F.length("v"),))]).first()
    assert (r.group_id, r.n_rows, r.v, r.v_id) == (0, 30_010, "10", 10)
