import re

from hypothesis import given, settings
from hypothesis import strategies as st

from skeinwork.llm.splitting import oversized_found, split_oversized


def pieces(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id bigint, t string, text string, piece_no int")  # names that clash with the result's
    return split_oversized(df, "id", "t", **kw).orderBy("id", "piece_no").collect()


def row(i, t):
    return (i, t, "other", 9)


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


def test_small_and_empty(spark):
    got = pieces(spark, [row(1, None), row(2, ""), row(3, " \n\n "), row(4, " a b\n"), row(4, " a b\n")], max_words=3, overlap_words=1)
    assert [(r.id, r.n_pieces, r.n_words, r.text) for r in got] == [(4, 1, 2, " a b")] * 2
    assert pieces(spark, []) == []


def test_boundaries(spark):
    text = words(4) + "\n \n" + words(3, 4) + ". " + words(5, 7) + "\n\n" + words(2, 12)
    got = pieces(spark, [row(1, text + " " * 40)], max_words=6, overlap_words=2)
    assert [(r.start_word, r.new_words, r.boundary, r.paragraph_no) for r in got] == [(0, 4, "paragraph", 1), (4, 3, "sentence", 2), (7, 4, "word", 2), (11, 3, "end", 2)]
    assert got[1].text.split()[:2] == ["w2", "w3"] and all(r.n_words <= 6 for r in got)


def test_found(spark):
    long = words(9)
    text = "H\r\n\r\n" + long + "\n\t\n" + words(3) + "\n\n" + long + "\n\n"
    df = split_oversized(spark.createDataFrame([(7, text), (8, words(8)), (9, "\n\n".join(["a b c d"] * 4))], "id bigint, t string"), "id", "t", 8, 2)
    assert sorted(tuple(r) for r in oversized_found(df, "id", 8).collect()) == [(7, 0), (7, 2), (7, 4), (9, 0)]


def test_very_long_word_and_unicode_space(spark):
    text = "x" * 100_000 + " " + "y z " * 40
    got = pieces(spark, [row(1, text)], max_words=10, overlap_words=3)
    assert got[0].text.startswith("x" * 100_000) and max(r.n_words for r in got) == 10


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb.", "c!", "\n", "\n\n", " ", "\r\n", " ", "é"]), max_size=120), st.integers(2, 9), st.integers(0, 1))
def test_round_trip(spark, parts, most, overlap):
    text = " ".join(parts)
    got = pieces(spark, [row(1, text)], max_words=most, overlap_words=overlap)
    whole = re.findall(r"\S+", text)
    new = []
    for r in got:
        w = re.findall(r"\S+", r.text)
        assert len(w) == r.n_words <= most and w[: r.overlap_words] == (new[-r.overlap_words :] if r.overlap_words else [])
        assert r.overlap_words == min(overlap, len(new))
        new += w[r.overlap_words :]
    assert new == whole
