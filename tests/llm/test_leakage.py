import random

import numpy as np

from skeinwork.llm import leakage
from skeinwork.llm.leakage import exact_leaks, paraphrases, words

DOC = "doc_id bigint, text string, item_id int, ids string"
ITEM = "item_id bigint, text string"


def brute(docs, items, n=12):
    grams = lambda t: {tuple(w[i : i + n]) for w in [words(t)] for i in range(len(w) - n + 1)}
    known = [(i, grams(t)) for i, t in items]
    return {(d, i) for d, t in docs for i, g in known if grams(t) & g}


def run(spark, docs, items, **kw):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], DOC)
    return {(r.doc_id, r.item_id): r.shared_words for r in exact_leaks(df, spark.createDataFrame(items, ITEM), **kw).collect()}


def test_against_brute_force(spark):
    rng = random.Random(2)
    common = [f"t{i}" for i in range(12)]
    sentence = lambda: [rng.choice(common) if rng.random() < 0.7 else f"n{rng.randrange(400)}" for _ in range(30)]
    items = [(i, " ".join(sentence())) for i in range(25)]
    docs = []
    for d in range(120):
        w = sentence() + sentence()
        if rng.random() < 0.6:
            own = items[rng.randrange(25)][1].split()
            size = rng.choice((9, 11, 12, 13, 20, 30))
            at = rng.randrange(max(1, len(own) - size + 1))
            w[rng.randrange(40) :] = own[at : at + size] + sentence()[: rng.randrange(9)]
        docs.append((d, " ".join(w)))
    want = brute(docs, items)
    assert set(run(spark, docs, items)) == want and len(want) > 20
    for stride in (1, 11):
        assert set(run(spark, docs, items, stride=stride)) == want


def test_noise_is_ignored(spark):
    item = "One two thrée four five six seven eight nine ten eleven twelve."
    loud = "x ONE **two** thrée\nfour_five [six], seven; eight-nine ten 'eleven' Twelve y"
    eleven = " ".join(item.split()[:11])
    broken = item.replace("six", "six 6")
    assert run(spark, [(1, loud), (2, eleven), (3, broken), (4, item + " " + item)], [(7, item)]) == {(1, 7): 12, (4, 7): 12}


def test_odd_rows(spark):
    item = " ".join(f"w{i}" for i in range(15))
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "a " * 30_000 + item)]
    items = [(1, item), (2, None), (3, ""), (4, "too short"), (5, item), (None, item)]
    assert run(spark, docs, items) == {(3, 1): 15, (3, 5): 15, (4, 1): 15, (4, 5): 15}
    assert run(spark, [], items) == {} and run(spark, docs, []) == {} and run(spark, docs, [(1, "!!")]) == {}


def test_blocks_of_items(spark, monkeypatch):
    from skeinwork.llm import leakage

    monkeypatch.setattr(leakage, "BLOCK_WORDS", 30)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(13))) for i in range(7)]
    docs = [(d, items[d][1] + " " + items[(d + 1) % 7][1]) for d in range(7)]
    assert set(run(spark, docs, items)) == brute(docs, items)


def test_paraphrases(spark):
    rng = random.Random(5)
    filler = [" ".join(f"f{rng.randrange(60)}" for _ in range(60)) for _ in range(40)]
    item = "police in vora seized ninety kilograms of copper wire that milo tasker had stored for the red lantern crew in june"
    told = "police in vora have seized about ninety kilograms of the copper wire milo tasker stored for the red lantern crew june"
    docs = [(i, t) for i, t in enumerate(filler)] + [(100, filler[0] + " " + told + " " + filler[1]), (101, None), (102, "")]
    got = paraphrases(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, item), (2, filler[3][:80])], ITEM))
    rows = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert (100, 1) in rows and rows[(100, 1)].answer_share >= 0.5
    assert all(d == 100 for d, i in rows if i == 1)


def test_paraphrases_at_every_start(spark):
    item = " ".join(f"w{i}" for i in range(45))
    docs = [(at, " ".join([f"f{at}x{k}" for k in range(at)] + item.split() + [f"g{at}x{k}" for k in range(60)])) for at in range(60, 90)]
    lone = [(1000 + k, "other text") for k in range(20)]
    got = paraphrases(spark.createDataFrame(docs + lone, "doc_id bigint, text string"), spark.createDataFrame([(1, item)], ITEM))
    assert {(r.doc_id, r.cosine, r.lcs_share) for r in got.collect()} == {(d, 1.0, 1.0) for d, _ in docs}


def test_paraphrases_of_skewed_lengths(spark):
    lengths = [10, 200] + [45] * 9
    items = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate(lengths)]
    inside = lambda i: " ".join([f"w{2 + (i + k) % 9}x{k}" for k in range(50)] + items[i][1].split() + [f"w{2 + (i + k) % 9}x{k}" for k in range(50)])
    docs = [(i, inside(i)) for i in range(len(lengths))] + [(1000 + k, "other text") for k in range(20)]
    got = paraphrases(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(len(lengths))}


def test_grid_finds_all_near_vectors():
    rng = np.random.default_rng(3)
    own = leakage._unit(rng.standard_normal((500, 20)).astype(np.float32))
    other = leakage._unit(own[rng.integers(0, 500, 300)] + rng.normal(0, 0.002, (300, 20)).astype(np.float32))
    row, bag = leakage.Grid(own).near(other)
    near = set(zip(*map(np.ndarray.tolist, np.nonzero(other @ own.T > leakage.NEAR))))
    assert len(near) > 100 and near <= set(zip(row.tolist(), bag.tolist())) and len(row) < 3000


def test_what_stands_with_a_leak(spark):
    item = " ".join(f"w{i}" for i in range(40))
    half = " ".join(item.split()[:20] + ["x"] * 5 + item.split()[25:])
    df = spark.createDataFrame([(1, half), (2, "other words")], "doc_id bigint, text string")
    rows = exact_leaks(df, spark.createDataFrame([(7, item)], ITEM)).collect()
    assert [(r.doc_id, r.item_id, r.shared_words, r.common_words) for r in rows] == [(1, 7, 20, 35)]
    assert rows[0].answer_share == 0.875
