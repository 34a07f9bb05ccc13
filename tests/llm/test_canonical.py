import random

import pytest

from skeinwork.llm.canonical import FOREIGN, NOISE, allowed, attach, map_values, weighted, weighted_all

LIST = [(1, "gang", ["street gang", "crew"]), (2, "mafia", ["crime family", None]), (3, "motorcycle_club", ["biker club", "biker club"]), (4, "drug_ring", None), (5, None, ["x"])]


def mapped(spark, values, listed=LIST):
    df = spark.createDataFrame([(i, v, "c", 0.1) for i, v in enumerate(values)], "mention_id bigint, type string, canonical string, cost double")
    return {r.value: (r.canonical, r.n) for r in map_values(df, spark.createDataFrame(listed, "type_id int, type string, known_forms array<string>"), noise=NOISE, foreign=FOREIGN).collect()}


def test_values(spark):
    values = {
        "GANG": "gang", " gang ": "gang", "gangs?": "gang", "gagn": "gang", "gabg": "gang", "former gang (alleged)": "gang", "StreetGang": "gang", "gang / street": "gang", "stree gagn": "gang",
        "crime  family": "mafia", "família, crime": "mafia", "Creq": "gang", "moto-club": "motorcycle_club", "Motorcycle clbu": "motorcycle_club", "biker.clubs": "motorcycle_club", "drug ring": "drug_ring",
        "bank": "unmatched", "family tree": "unmatched", "??": "unmatched", "gh2f": "unmatched", "person": "unmatched", "x" * 5000: "unmatched",
    }
    assert {v: c for v, (c, _) in mapped(spark, list(values)).items()} == values


def test_absent_exact_repeated(spark):
    assert mapped(spark, [None, "", " ", "Unknown", "n/a", "gang", "Gang", "Gang"]) == {"Gang": ("gang", 2)}
    assert mapped(spark, []) == {}
    assert mapped(spark, ["gang", "q"], []) == {"gang": ("unmatched", 1), "q": ("unmatched", 1)}


def test_ranking_by_frequency(spark):
    listed = [(1, "bat", []), (2, "bats club", []), (3, "cartage", []), (4, "cardage", [])]
    assert mapped(spark, ["carmage"] + ["cardage"] * 3 + ["cartage"], listed)["carmage"][0] == "cardage"
    assert mapped(spark, ["carmage"] + ["cardage"] + ["cartage"] * 3, listed)["carmage"][0] == "cartage"


def test_weights():
    assert weighted("gang", "gang") == 0
    assert weighted("gsng", "gang") == pytest.approx(0.7) and weighted("gbng", "gang") == pytest.approx(1.1)
    assert weighted("gnag", "gang") == pytest.approx(0.8) and weighted("gangg", "gang") == pytest.approx(0.5)
    assert weighted("", "ab") == pytest.approx(1.8)
    assert [allowed(n) for n in (3, 4, 6)] == [0.0, 1.0, 2.0]


def test_attach(spark):
    rows = spark.createDataFrame([(1, "Gang", 1), (1, "Gang", 2), (2, "bank", 1), (2, "Crew", 5), (3, "gang", 1), (None, "Gang", 1)], "mention_id bigint, type string, loaded_at int")
    mapping = map_values(rows, spark.createDataFrame(LIST, "type_id int, type string, known_forms array<string>"))
    assert sorted(map(tuple, attach(rows, mapping, "mention_id", "type", "loaded_at").collect())) == [(1, "gang"), (2, "gang")]


def test_attach_without_broadcast(spark, monkeypatch):
    from skeinwork.llm import canonical

    monkeypatch.setattr(canonical, "_BROADCAST_VALUES", 0)
    test_attach(spark)


def test_weights_of_many():
    rng = random.Random(3)
    left = ["".join(rng.choice("asdq") for _ in range(rng.randrange(14))) for _ in range(800)]
    right = ["".join(c for c in x if rng.random() < 0.9) + rng.choice(["", "a", "q"]) for x in left]
    for x, y, got in zip(left, right, weighted_all(left, right)):
        exact = weighted(x, y)
        assert got == pytest.approx(exact) if exact <= 2 else got > 2


def test_long_list_by_shuffle(spark, monkeypatch):
    from skeinwork.llm import canonical

    monkeypatch.setattr(canonical, "bounded", canonical.shuffled)
    syllables = ["ka", "lo", "mi", "ra", "zu", "te", "vo", "ni"]
    names = ["".join(syllables[i >> (3 * k) & 7] for k in range(5)) for i in range(6000)]
    listed = [(i, n, None) for i, n in enumerate(names)]
    slip = names[4321][:5] + "x" + names[4321][5:]
    assert mapped(spark, [slip, names[7], "quite another thing"], listed) == {slip: (names[4321], 1), "quite another thing": ("unmatched", 1)}


def test_many_words_in_any_order(spark):
    assert mapped(spark, ["five four three two one", "four five three one six"], [(1, "one two three four five", [])]) == {"five four three two one": ("one two three four five", 1), "four five three one six": ("unmatched", 1)}
