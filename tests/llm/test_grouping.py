import random

from skeinwork.llm.grouping import groups_found, low_diameter_groups, node_groups, shared_key_edges
from skeinwork.operators.joins import hot_values, spread_join

NODE = "node_id bigint, standard_name string, aliases array<string>, group_id string, key int"
MATCH = "left_id bigint, right_id bigint, verdict string"


def brute(pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in up}


def run(spark, pairs, kind="bigint"):
    return {r.id: r.group_id for r in low_diameter_groups(spark.createDataFrame(pairs, f"a {kind}, b {kind}")).collect()}


def test_random_graphs(spark):
    for seed in (1, 2):
        rng = random.Random(seed)
        pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
        pairs = [p for p in pairs if p[0] != p[1]]
        assert run(spark, pairs) == brute(pairs)


def test_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    assert set(run(spark, chain).values()) == {0}
    star = [(0, i) for i in range(1, 300)]
    assert set(run(spark, star).values()) == {0}


def test_odd_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, 1), (None, 2), (3, None)]) == {}
    assert run(spark, [(2, 1), (1, 2), (2, 1)]) == {1: 1, 2: 1}
    assert run(spark, [("b", "a")], "string") == {"a": "a", "b": "a"}


def test_every_level_by_decomposition(spark):
    rng = random.Random(5)
    pairs = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(60, 90)] + [(200, 201), (rng.randrange(60), 75)]
    found = low_diameter_groups(spark.createDataFrame(pairs, "a bigint, b bigint"), base=0)
    assert {r.id: r.group_id for r in found.collect()} == brute(pairs)


def test_hot_keys(spark):
    left = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(200)] + [(None, 1)], "k bigint, x bigint")
    right = spark.createDataFrame([(k, str(k)) for k in range(5)], "k bigint, y string")
    assert hot_values(left, "k", 200, least=50, share=4) == [0] and hot_values(left, "k", 200) == []
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain, salted = (sorted(map(str, spread_join(left, right, "k", hot, how).collect())) for hot in ([], [0, 3]))
        assert plain == salted


def test_shared_keys(spark):
    rows = [(i, "k") for i in range(100)] + [(200, "x"), (201, None), (None, "k"), (5, "k")]
    edges = shared_key_edges(spark.createDataFrame(rows, "id bigint, key string"), salts=4)
    pairs = [tuple(r) for r in edges.collect()]
    assert brute(pairs) == dict.fromkeys(range(100), 0) and len(pairs) <= 104


def test_nodes(spark):
    nodes = [(1, " The  A", None, "g", 1), (2, "the a", [], "g", 1), (3, "x", ["THE A", None, "N/A"], "g", 1), (4, "The Gang", ["none"], "g", 1), (5, "the gang", ["NONE", ""], "g", 1), (6, None, None, "g", 1), (7, "q", None, "g", 1), (7, "q", None, "g", 1), (None, "q", None, "g", 1)]
    matches = [(6, 7, "same"), (7, 6, "same"), (4, 5, "unsure"), (4, 4, "same"), (5, 99, "same"), (99, 4, "same"), (None, 4, "same"), (1, 4, None)]
    groups = node_groups(spark.createDataFrame(nodes, NODE), spark.createDataFrame(matches, MATCH), spark.createDataFrame([("the gang",), (None,)], "name string"))
    assert {r.node_id: r.group_id for r in groups.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6}
    assert sorted(r.node_id for r in groups_found(groups).collect()) == [1, 2, 3, 6, 7]


def test_empty_tables(spark):
    none = node_groups(spark.createDataFrame([], NODE), spark.createDataFrame([], MATCH), spark.createDataFrame([], "name string"))
    assert none.count() == 0
