import random

import pytest

from skeinwork.llm import recompression as R
from skeinwork.llm.spans import SharedSpans


def brute(docs, least):
    """Pairs that share a span, and the covered characters of each text."""
    at = {}
    for i, t in docs:
        for s in range(len(t or "") - least + 1):
            at.setdefault(t[s : s + least], set()).add((i, s))
    pairs, cover = set(), {}
    for places in at.values():
        ids = {i for i, _ in places}
        if len(ids) > 1:
            pairs |= {(a, b) for a in ids for b in ids if a < b}
            for i, s in places:
                cover.setdefault(i, set()).update(range(s, s + least))
    return pairs, {i: len(c) for i, c in cover.items()}


def check(spark, docs, least=R.shortest_stretch(), hot=64):
    df = spark.createDataFrame([(i, t, "c", 5) for i, t in docs], "doc_id bigint, text string, h string, pos int")
    s = SharedSpans(df, min_chars=least, hot=hot)
    pairs, cover = brute(docs, least)
    got = [tuple(r) for r in s.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    assert {r.doc_id: r.shared_chars for r in s.shares().collect() if r.shared_chars} == cover
    return s


def texts(rng, least, n=14):
    letters = "abcdefgh \n"
    make = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [make(least + rng.choice((-1, 0, 1, 30, 400))) for _ in range(5)]
    docs = [(i, make(rng.randrange(200)) + "".join(rng.choice(shared) + make(rng.randrange(40)) for _ in range(rng.randrange(3))) + make(50)) for i in range(n)]
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random(spark, seed):
    least = R.shortest_stretch()
    docs = texts(random.Random(seed), least)
    check(spark, docs, least)
    check(spark, docs, least, hot=1)  # all windows named again instead of paired


def test_edges_of_the_length(spark):
    rng = random.Random(9)
    least = R.shortest_stretch()
    core = "".join(rng.choice("abcdefghij ") for _ in range(least))
    docs = [(1, "x" + core + "y"), (2, "z" + core + "q"), (3, core[1:] + "p"), (4, core), (5, core[:-1] + "~" + core[1:])]
    s = check(spark, docs, least)
    assert {(r.doc_a, r.doc_b, r.length) for r in s.stretches.collect()} == {(1, 2, least), (1, 4, least), (2, 4, least)}


def test_repetitions(spark):
    least = R.shortest_stretch()
    docs = [(1, " " * 500 + "a"), (2, "b" + " " * 450), (3, "ab" * 200), (4, "xab" + "ab" * 150), (5, "abc" * 120), (6, "q" * (least - 1))]
    check(spark, docs, least)


def test_copies_and_odd_rows(spark):
    rng = random.Random(4)
    body = "".join(rng.choice("abcdef ") for _ in range(400))
    docs = [(1, body), (2, body), (3, body), (4, "pre" + body), (5, None), (6, ""), (7, "short"), (8, body[:300] + "é𝄞" + body[:50])]
    check(spark, docs)
    df = spark.createDataFrame(docs + [(1, body)], "doc_id bigint, text string")
    s = SharedSpans(df, min_chars=R.shortest_stretch())
    assert s.pairs().count() == len(brute(docs, R.shortest_stretch())[0])
    assert s.shares().filter("doc_id = 1").count() == 1


def test_long_texts_in_parts(spark):
    from skeinwork.llm import spans

    rng = random.Random(11)
    rows = [(i, "".join(rng.choice("abcdef  ") for _ in range(n))) for i, n in enumerate((900, 5000, 100, 2500))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    whole = sorted(map(tuple, spans.symbol_names(df, 80).collect()))
    parted = sorted(map(tuple, spans.symbol_names(df, 80, chunk=1500, part=700).collect()))
    assert parted != whole
    # at the ends of texts that are joined with others some more points are chosen, which does no harm
    inside = lambda rows: {r for r in rows if 200 <= r[2] <= {0: 900, 1: 5000, 3: 2500}.get(r[1], 0) - 300}
    assert inside(parted) == inside(whole) and len(inside(whole)) > 100


def test_empty_and_bounds(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    s = SharedSpans(df)
    assert s.pairs().count() == 0 and s.shares().count() == 0
    with pytest.raises(ValueError):
        SharedSpans(df, min_chars=R.shortest_stretch() - 1)


def test_symbols_agree_inside_equal_stretches():
    import numpy as np

    rng = random.Random(7)
    core = "".join(rng.choice("abcde  ") for _ in range(600))
    lost = R.lost_at_an_end()
    for left, right in (("", "zz"), ("qq" * 40, ""), ("   ", "a" * 90)):
        codes = R.code_points(left + core + right)
        name, pos = R.symbols(codes, np.array([0]))
        inside = {(int(p) - len(left), int(n)) for n, p in zip(name, pos) if lost <= p - len(left) < 600 - lost - R.CAP}
        first = inside if left == "" else first  # noqa: F821
        assert inside == first and len(inside) > 50
