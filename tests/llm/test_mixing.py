import pytest

from skeinwork.llm.mixing import Mixture
from skeinwork.llm.queries import VOCABULARY

DOC = "doc_id bigint, source string, text string, size int, copies string"


def mixture(spark, docs, targets, **kw):
    df = spark.createDataFrame([(i, s, t, 1, "c") for i, s, t in docs], DOC)
    return Mixture(df, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), VOCABULARY, **kw)


def test_shares(spark):
    docs = [(i, "a", "word " * (1 + i % 7)) for i in range(3000)] + [(10_000 + i, "b", "word " * (1 + i % 5)) for i in range(400)] + [(20_000 + i, "c", "word word") for i in range(50)]
    m = mixture(spark, docs, [("a", 0.5, 1), ("b", 0.3, 9), ("c", 0.1, 2), ("none", 0.1, 5)])
    r = {x.source: x for x in m.report().collect()}
    assert r["a"].share_of_total == pytest.approx(0.5, abs=0.01) and r["b"].share_of_total == pytest.approx(0.3, abs=0.01)
    assert r["a"].most_copies == 1 and r["c"].most_copies == 2 and r["c"].copies == 100
    assert sum(x.actual_share for x in r.values()) == pytest.approx(1, abs=1e-5)
    assert sorted(x.source for x in m.unreachable().collect()) == ["c", "none"]
    want = sum(x.copies for x in m.sample().collect())
    assert m.records().count() == want
    spread = {x.copies for x in m.sample().filter("source = 'b'").collect()}
    assert max(spread) - min(spread) <= 1


def test_shares_against_closed_form(spark, sf):
    """Of every source the sample gives its share of the total, or all it may repeat, up to a few texts and two per cent."""
    from skeinwork.llm.queries import QUERIES

    rows = QUERIES["p7_shares"](spark, sf).collect()
    sizes = spark.read.parquet(f"{sf}/documents.parquet")
    m = Mixture(sizes, spark.read.parquet(f"{sf}/source_targets.parquet"), VOCABULARY)
    total = m.counts.selectExpr("sum(n_tokens)").first()[0]
    longest = {r[0]: r[1] for r in m.counts.groupBy("source").max("n_tokens").collect()}
    for r in rows:
        want = min(r.target_share * total, r.max_repeats * r.size_tokens)
        assert abs(r.tokens - want) <= 3 * longest.get(r.source, 0) + 0.02 * want and r.most_copies <= r.max_repeats


def test_same_seed_same_sample(spark):
    docs = [(i, "a", f"text {i}") for i in range(200)]
    one, two, other = (mixture(spark, d, [("a", 0.4, 1)], seed=s).sample() for d, s in ((docs, 1), (docs[::-1], 1), (docs, 2)))
    assert sorted(one.collect()) == sorted(two.collect()) != sorted(other.collect())


def test_odd_rows(spark):
    docs = [(1, "a", None), (2, "a", ""), (3, None, "x y"), (None, "a", "x"), (4, "zz", "long text here"), (5, "e", ""), (6, "a", "y"), (6, "a", "y")]
    m = mixture(spark, docs, [("a", 0.2, 3), ("a", 0.1, 2), ("e", 0.1, 5), (None, 0.4, 1), ("n", None, None)])
    r = {x.source: x for x in m.report().collect()}
    assert set(r) == {"a", "e", "n"} and r["a"].max_repeats == 3 and r["n"].reachable and not r["e"].reachable
    assert {x.doc_id for x in m.sample().collect()} <= {1, 2, 6}


def test_empty(spark):
    m = mixture(spark, [], [("a", 1.0, 1)])
    assert m.sample().count() == 0 and m.report().first().actual_share is None
    assert mixture(spark, [(1, "a", "x")], []).report().count() == 0


def test_found_runs_the_sample(spark, sf):
    from skeinwork.llm.queries import QUERIES

    found = QUERIES["p7_found"](spark, sf)
    assert "Window" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(found.collect()) == sorted((r.source,) for r in QUERIES["p7_shares"](spark, sf).filter("not reachable").collect())
