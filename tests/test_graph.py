"""Graph operators on graphs small enough to count by hand, and against brute force."""

import inspect
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinwork.operators.graph import blocks as B
from skeinwork.operators.graph import centrality as Z
from skeinwork.operators.graph import clustering as K
from skeinwork.operators.graph import layers as L
from skeinwork.operators.graph import local
from skeinwork.operators.graph import traversal as T
from skeinwork.plans import census_queries, graph_queries


def graph(spark, *pairs):
    rows = [(min(p), max(p)) for p in pairs]
    return spark.createDataFrame([(a, b, rows.count((a, b))) for a, b in sorted(set(rows))], "a string, b string, m bigint")


PATH, STAR, TRIANGLE = ["ab", "bc", "cd"], ["xa", "xb", "xc", "xd"], ["ab", "bc", "ac"]


def by_v(df, c):
    return {r.v: r[c] for r in df.collect()}


def test_layer(spark):
    e = spark.createDataFrame([("a", "b", "x"), ("b", "a", "x"), ("a", "a", "x"), ("a", "", "x"), ("a", "c", "y"), (None, "c", "x")], "source string, target string, relationship string")
    assert sorted(tuple(r) for r in L.layer(e, "x").collect()) == [("a", "b", 2)]
    assert L.layer(e).count() == 2
    d = L.degrees(L.layer(e)).filter("v = 'a'").first()
    assert (d.degree, d.neighbours) == (3, 2)
    assert [r.v for r in L.isolates(spark.createDataFrame([("a",), ("q",)], "v string"), L.layer(e)).collect()] == ["q"]


def test_betweenness(spark):
    assert by_v(Z.betweenness(graph(spark, *PATH)), "betweenness") == pytest.approx({"a": 0, "b": 2 / 3, "c": 2 / 3, "d": 0})
    assert by_v(Z.betweenness(graph(spark, *STAR)), "betweenness")["x"] == pytest.approx(1)
    assert by_v(Z.betweenness(graph(spark, "ab")), "betweenness") == {"a": 0, "b": 0}
    assert Z.betweenness(graph(spark, "ab").limit(0)).count() == 0
    square = graph(spark, "ab", "ab", "bd", "ac", "cd")
    assert by_v(Z.betweenness(square), "betweenness")["b"] == pytest.approx(1 / 6)
    assert by_v(Z.betweenness(square, collapse_parallel=False), "betweenness")["b"] == pytest.approx(2 / 3 / 3)


def test_betweenness_by_joins(spark):
    rng = random.Random(1)
    pairs = [(chr(97 + a), chr(97 + b)) for a, b in itertools.combinations(range(9), 2) if rng.random() < 0.3]
    g = graph(spark, *pairs)
    want = by_v(Z.betweenness(g, collapse_parallel=False), "betweenness")
    scratch = Z.Scratch(spark, "test")
    assert by_v(Z._betweenness_by_joins(g, scratch, blocks=2), "betweenness") == pytest.approx(want)


BOTH_WAYS = pytest.mark.parametrize("local_edges", [0, 1000])


@BOTH_WAYS
def test_components(spark, local_edges):
    rng = random.Random(3)
    pairs = [(f"{a:02}", f"{rng.randrange(60):02}") for a in range(60) for _ in range(1) if rng.random() < 0.7]
    pairs = [p for p in pairs if p[0] != p[1]] + [("70", "71")]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = by_v(T.components(graph(spark, *pairs), local_edges=local_edges), "component")
    assert got == {v: find(v) for v in up}
    assert T.components(graph(spark, "ab").limit(0), local_edges=local_edges).count() == 0


def test_sizes(spark):
    g = graph(spark, *TRIANGLE, "xy", "xy")
    labels = T.components(g)
    assert sorted((r.component, r.n_nodes, r.n_edges) for r in T.component_sizes(g, labels).collect()) == [("a", 3, 3), ("x", 2, 2)]
    assert T.largest_component(g, labels).count() == 3


@BOTH_WAYS
def test_cores(spark, local_edges):
    g = graph(spark, *TRIANGLE, "cd", "de", "xy")
    assert by_v(T.core_numbers(g, local_edges=local_edges), "core") == {"a": 2, "b": 2, "c": 2, "d": 1, "e": 1, "x": 1, "y": 1}
    k5 = graph(spark, *("".join(p) for p in itertools.combinations("abcde", 2)), "ef")
    assert by_v(T.core_numbers(k5, local_edges=local_edges), "core") == {**dict.fromkeys("abcde", 4), "f": 1}


@BOTH_WAYS
def test_distances(spark, local_edges):
    g = graph(spark, *PATH, "xy")
    assert by_v(T.distances(g, "a", local_edges=local_edges), "distance") == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert T.distances(g, "none", local_edges=local_edges).count() == 0
    assert T.pseudo_diameter(g, "b") == 3


@BOTH_WAYS
def test_distances_are_whole_or_raise(spark, local_edges):
    g = graph(spark, *PATH)
    assert by_v(T.distances(g, "a", max_depth=3, local_edges=local_edges), "distance") == {"a": 0, "b": 1, "c": 2, "d": 3}
    with pytest.raises(Exception, match="beyond 2 steps"):
        T.distances(g, "a", max_depth=2, local_edges=local_edges).collect()


def test_betweenness_by_joins_is_whole_or_raises(spark):
    g, scratch = graph(spark, *PATH), Z.Scratch(spark, "test")
    assert by_v(Z._betweenness_by_joins(g, scratch, blocks=1, max_depth=3), "betweenness")["b"] == pytest.approx(2 / 3)
    with pytest.raises(RuntimeError, match="beyond 2 steps"):
        Z._betweenness_by_joins(g, scratch, blocks=1, max_depth=2)


def test_no_depth_is_set():
    assert [inspect.signature(f).parameters["max_depth"].default for f in (T.distances, Z._betweenness_by_joins)] == [None, None]


def test_clustering(spark):
    g = graph(spark, *TRIANGLE, "cd")
    assert by_v(K.local_clustering(g), "clustering") == {"a": 1, "b": 1, "c": pytest.approx(1 / 3, abs=1e-6)}
    s = K.clustering_summary(g).first()
    assert (s.transitivity, s.mean_local_clustering) == (0.6, pytest.approx(7 / 9, abs=1e-6))
    assert by_v(K.triangles(graph(spark, *("".join(p) for p in itertools.combinations("abcd", 2)))), "n") == dict.fromkeys("abcd", 3)


def test_mixing(spark):
    types = spark.createDataFrame([(v, "t") for v in "abc"], "v string, type string")
    assert K.type_assortativity(graph(spark, *TRIANGLE), types).first()[0] == 1.0
    assert K.type_assortativity(graph(spark, *TRIANGLE).limit(0), types).first()[0] == 0.0
    half = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "t"), ("d", "t")], "v string, type string")
    assert K.type_assortativity(graph(spark, "ab", "cd"), half).first()[0] == 1.0
    assert K.type_assortativity(graph(spark, "ac", "bd"), half).first()[0] == -1.0


@BOTH_WAYS
def test_pagerank(spark, local_edges):
    r = by_v(Z.pagerank(graph(spark, *STAR), local_edges=local_edges), "pagerank")
    assert sum(r.values()) == pytest.approx(1) and r["x"] == pytest.approx(0.4757, abs=1e-3)
    alone = spark.createDataFrame([(v,) for v in "abcdxz"], "v string")
    r = by_v(Z.pagerank(graph(spark, *STAR), alone, local_edges=local_edges), "pagerank")
    assert sum(r.values()) == pytest.approx(1) and r["z"] < min(r[v] for v in "abcd")


def test_signed_and_ranks(spark):
    p, n = graph(spark, "ab", "ac", "bc"), graph(spark, "ab", "de")
    s = {r.v: tuple(r)[1:] for r in L.signed_degrees(p, n).collect()}
    assert s["a"] == (2, 1, 3, 1, 2) and s["d"] == (0, 1, 1, -1, 0) and s["c"] == (2, 0, 2, 2, 0)
    assert [tuple(r) for r in L.contradictory(p, n).collect()] == [("a", "b")]
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 1.0), ("d", None)], "v string, x double")
    assert by_v(L.positions(df, {"x": "rank"}), "rank") == {"b": 1, "a": 2, "c": 3, "d": 4}
    many = [(f"{i:04}", float(i * 7919 % 11)) for i in range(2000)]
    got = by_v(L.positions(spark.createDataFrame(many, "v string, x double").repartition(7), {"x": "r"}), "r")
    assert got == {v: i + 1 for i, (v, _) in enumerate(sorted(many, key=lambda r: (-r[1], r[0])))}
    assert L.ego(graph(spark, *TRIANGLE, "cd", "de"), "a").count() == 3


def test_core_composition(spark):
    cores = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "v string, core bigint")
    types = spark.createDataFrame([("a", "x"), ("c", "x")], "v string, type string")
    got = sorted(tuple(r) for r in T.core_composition(cores, types).collect())
    assert got == [(1, "unknown", 1, 0.5, 0.0), (1, "x", 1, 0.5, 0.5), (2, "x", 1, 1.0, 0.0)]


def test_scaled(spark):
    from skeinwork.operators.census import scaled

    df = spark.createDataFrame([("a", 0), ("b", 9)], "v string, x int")
    assert {r.v: r.size for r in scaled(df, "x").collect()} == {"a": 1.0, "b": 10.0}
    assert F is not None


def test_pseudo_diameter_of_the_largest_component(spark, monkeypatch):
    from skeinwork.plans import graph_queries as Q

    monkeypatch.setattr(Q, "_layer", lambda *_: graph(spark, *STAR, "ef", "fg", "gh", "hi", "ij", "jk", "kl"))
    assert [tuple(r) for r in Q.pseudo_diameter(spark, "").collect()] == [("alliance", 7), ("rivalry", 7)]


def test_pseudo_diameter_sweeps_to_the_end(spark, monkeypatch):
    far = iter([*range(1, 13), 12])
    monkeypatch.setattr(T, "distances", lambda edges, start: spark.createDataFrame([("v", next(far))], "v string, distance int"))
    assert T.pseudo_diameter(None, "a") == 12


def test_long_chain_in_either_way(spark):
    chain = spark.createDataFrame([(f"{i:05d}", f"{i + 1:05d}", 1) for i in range(1500)], "a string, b string, m int")
    assert T.distances(chain, "00000").agg({"distance": "max"}).first()[0] == 1500
    assert {r.core for r in T.core_numbers(chain).collect()} == {1}
    assert T.components(chain, local_edges=0).select("component").distinct().count() == 1
    short = chain.filter("a < '00012'")
    assert T.distances(short, "00000", local_edges=0).agg({"distance": "max"}).first()[0] == 12
    assert {r.core for r in T.core_numbers(short, local_edges=0).collect()} == {1}


def test_ranks_of_both_ways_agree(spark):
    rng = random.Random(9)
    pairs = [(chr(97 + rng.randrange(20)), chr(97 + rng.randrange(20))) for _ in range(40)]
    g = graph(spark, *[p for p in pairs if p[0] != p[1]])
    one, two = (by_v(Z.pagerank(g, local_edges=n), "pagerank") for n in (0, 1000))
    assert one == pytest.approx(two, abs=1e-7)



def _brandes(n, pairs):
    """By definition: shortest paths counted from every vertex, parallel edges as paths of their own."""
    near = {v: {} for v in range(n)}
    for (a, b), m in pairs.items():
        near[a][b] = near[b][a] = m
    score = [0.0] * n
    for s in range(n):
        far, paths, order = {s: 0}, {s: 1}, [s]
        for v in order:
            for w, m in near[v].items():
                if w not in far:
                    far[w], paths[w] = far[v] + 1, 0
                    order.append(w)
                if far[w] == far[v] + 1:
                    paths[w] += paths[v] * m
        need = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v, m in near[w].items():
                if far[v] == far[w] - 1:
                    need[v] += paths[v] * m / paths[w] * (1 + need[w])
            score[w] += need[w] * (w != s)
    return score


@pytest.mark.parametrize("together", [1, 20_000])
def test_betweenness_by_blocks(monkeypatch, together):
    monkeypatch.setattr(B, "_TOGETHER", together)
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 30)
        pairs = {(a, b): rng.randrange(1, 4) for a, b in itertools.combinations(range(n), 2) if rng.random() < rng.choice((0.03, 0.08, 0.2))}
        a, b, m = (np.array(x, dtype=np.int64) for x in ([p[0] for p in pairs], [p[1] for p in pairs], list(pairs.values())))
        g = B.split(n, a, b, m)
        cut = rng.randrange(len(g.vertex) + 1)
        places = B.dependencies(g, 0, cut) + B.dependencies(g, cut, len(g.vertex))
        assert g.base + np.bincount(g.vertex, places, minlength=n) == pytest.approx(_brandes(n, pairs))


@pytest.mark.parametrize("small", [2, 5])
def test_betweenness_by_the_hub_of_a_block(monkeypatch, small):
    monkeypatch.setattr(B, "_SMALL", small)
    rng = random.Random(7)
    for _ in range(60):
        n, hub = rng.randrange(3, 30), rng.choice((0.2, 0.6))
        pairs = {(a, b): rng.randrange(1, 4) for a, b in itertools.combinations(range(n), 2) if rng.random() < (hub if a == 0 else rng.choice((0.03, 0.1)))}
        a, b, m = (np.array(x, dtype=np.int64) for x in ([p[0] for p in pairs], [p[1] for p in pairs], list(pairs.values())))
        g = B.split(n, a, b, m)
        cut = rng.randrange(len(g.vertex) + 1)
        places = B.dependencies(g, 0, cut) + B.dependencies(g, cut, len(g.vertex))
        assert g.base + np.bincount(g.vertex, places, minlength=n) == pytest.approx(_brandes(n, pairs))


def test_searches_stay_around_their_sources(monkeypatch):
    """A wheel: on the rim two steps are tied with the way by the hub, and farther places are told by the hub alone."""
    rim, reached, levels = 20_000, [], B._levels
    monkeypatch.setattr(B, "_levels", lambda *x: reached.append(out := levels(*x)) or out)
    ring = np.arange(1, rim + 1)
    a, b = np.concatenate((np.zeros(rim, dtype=np.int64), ring)), np.concatenate((ring, np.roll(ring, 1)))
    g = B.split(rim + 1, a, b, np.ones_like(a))
    score = g.base + np.bincount(g.vertex, B.dependencies(g, 0, len(g.vertex)), minlength=rim + 1)
    assert score[0] == rim * (rim - 1) - 3 * rim and (score[1:] == 1).all()
    assert sum(len(x.place) for x in itertools.chain(*reached)) <= 6 * (rim + 1)  # 400 million places, were each search over the whole


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_measures_are_joined_by_numbers(spark, monkeypatch, limit):
    g = graph(spark, *PATH, *STAR, *TRIANGLE, "ab")
    want = {v: {} for v in "abcdx"}
    for c, frame in (("degree", L.degrees(g)), ("betweenness", Z.betweenness(g, collapse_parallel=False)), ("pagerank", Z.pagerank(g)), ("core", T.core_numbers(g))):
        for v, value in by_v(frame, c).items():
            want[v][c] = value
    h = graph(spark, *PATH, *STAR, *TRIANGLE, "ab")
    if not limit:
        monkeypatch.setattr(Z.local, "numbered", lambda *x: None)
    got = Z.measures(h)
    assert dict(got.dtypes) == {"v": "string", "degree": "bigint", "betweenness": "double", "pagerank": "double", "core": "bigint"}
    rows = {r.v: r.asDict() for r in got.collect()}
    assert rows.keys() == want.keys() and all(rows[v][c] == pytest.approx(want[v][c]) for v in want for c in want[v])


def _folder(spark, at, edges):
    nodes = [(k, f"Org {c}", "gang") for k, c in enumerate("abcdef")] + [(9, "Org z", "no such type")]
    spark.createDataFrame(nodes, "node_id long, standard_name string, type string").write.parquet(f"{at}/global_network_nodes.parquet")
    rows = [(k, *e) for k, e in enumerate(edges)]
    spark.createDataFrame(rows, "edge_id long, source string, target string, relationship string").write.parquet(f"{at}/global_network_edges.parquet")
    return str(at)


def test_names_are_numbered_once_for_all_views(spark, sf, tmp_path, monkeypatch):
    calls, positions = [], local.positions
    monkeypatch.setattr(local, "positions", lambda *x: calls.append(x) or positions(*x))
    d = _folder(spark, tmp_path, [("Org a", "Org b", "alliance"), ("Org b", "org  C", "Rivalry"), ("Org c", "Org z", "alliance"), ("Org b", "Org d", "other"), ("Org a", "Org a", "alliance"), (None, "Org a", "rivalry"), ("", "Org b", "rivalry")])
    got = {(r.view, r.name): r.size for r in census_queries.QUERIES["viewer_sizes"](spark, d).collect()}
    assert got == {(view, f"org {c}"): 42.0 if (view, c) == ("combined", "b") else 2.0 for view in ("alliance", "rivalry", "combined") for c in "abcdef"}
    assert len(calls) == 1


def test_layers_of_the_master_frame_share_their_numbers(spark, sf, monkeypatch):
    # combined, alliance and rivalry were numbered apart
    calls, positions = [], local.positions
    monkeypatch.setattr(local, "positions", lambda *x: calls.append(x) or positions(*x))
    graph_queries.QUERIES["master_frame"](spark, sf)
    assert len(calls) == 1


def test_search_of_the_viewer_needs_no_order_of_names(spark, sf, monkeypatch):
    # numbers followed the names, which took a sort of all of them
    monkeypatch.setattr(local, "positions", lambda *x: pytest.fail("names were put in order"))
    census_queries.QUERIES["viewer_search"](spark, sf)


@pytest.mark.parametrize("edges", [[("Org e", "Org f", "alliance")], []])
def test_top_betweenness_has_organisations_without_edges(spark, tmp_path, edges):
    rows = graph_queries.QUERIES["top_betweenness"](spark, _folder(spark, tmp_path, edges)).collect()
    assert [(r.v, r.betweenness) for r in rows] == [(f"org {c}", 0.0) for c in "abcde"]


def test_betweenness_of_a_large_tree(spark):
    # 60,000 sources of 60,000 vertices each, were they searched; the blocks of a tree are not
    n = 60_000
    tree = spark.range(1, n).select(F.format_string("%06d", F.floor((F.col("id") - 1) / 2)).alias("a"), F.format_string("%06d", "id").alias("b"), F.lit(1).alias("m"))
    got = by_v(Z.betweenness(tree), "betweenness")
    size = [1] * n
    for v in range(n - 1, 0, -1):
        size[(v - 1) // 2] += size[v]
    for v in (0, 1, 2, 77, 20_000, n - 1):
        branches = [size[c] for c in (2 * v + 1, 2 * v + 2) if c < n] + [n - size[v]]
        assert got[f"{v:06d}"] == pytest.approx(((n - 1) ** 2 - sum(x * x for x in branches)) / ((n - 1) * (n - 2)))


def test_ranks_and_cores_by_numbers(spark):
    # more edges than one task takes with their names
    rng = random.Random(4)
    pairs = [(chr(97 + rng.randrange(20)), chr(97 + rng.randrange(20))) for _ in range(40)]
    g = graph(spark, *[p for p in pairs if p[0] != p[1]])
    more = spark.createDataFrame([("a",), ("zz",)], "v string")
    want = by_v(Z.pagerank(g), "pagerank"), by_v(Z.pagerank(g, more), "pagerank"), by_v(T.core_numbers(g), "core")
    g = g.select("*")
    got = by_v(Z.pagerank(g, local_edges=1), "pagerank"), by_v(Z.pagerank(g, more, local_edges=1), "pagerank"), by_v(T.core_numbers(g, local_edges=1), "core")
    assert [pytest.approx(x) for x in want] == list(got) and vars(g)["_skein_numbers"].size == g.count()


def test_numbers_are_made_once(spark, monkeypatch):
    # ranks, cores and betweenness of one frame share them
    made = []
    monkeypatch.setattr(local, "positions", lambda *x: made.append(x) or L.positions(*x))
    g = graph(spark, *TRIANGLE, "cd")
    Z.betweenness(g), Z.betweenness(g, collapse_parallel=False), Z.pagerank(g), T.core_numbers(g)
    assert len(made) == 1


def test_components_and_distances_by_numbers(spark):
    g = graph(spark, *PATH, "xy", "yz", "ez")
    assert by_v(T.components(g, local_edges=1), "component") == by_v(T.components(g.select("*")), "component") == {**dict.fromkeys("abcd", "a"), **dict.fromkeys("exyz", "e")}
    assert by_v(T.distances(g, "b", local_edges=1), "distance") == {"a": 1, "b": 0, "c": 1, "d": 2}
    assert T.distances(g, "none", local_edges=1).count() == 0 and vars(g)["_skein_numbers"].n == 8
    with pytest.raises(Exception, match="beyond 1 steps"):
        T.distances(g, "b", max_depth=1, local_edges=1).collect()


@BOTH_WAYS
def test_one_task_makes_all_sweeps(spark, monkeypatch, local_edges):
    rng = random.Random(8)
    for _ in range(3):
        pairs = [(chr(97 + rng.randrange(18)), chr(97 + rng.randrange(18))) for _ in range(18)]
        g = graph(spark, *[p for p in pairs if p[0] != p[1]])
        start = g.first()["a"]
        want = T.pseudo_diameter(g.select("*"), start)
        with monkeypatch.context() as m:
            if local_edges:
                m.setattr(T, "distances", None)
            assert T.diameter(g, start, local_edges=local_edges) == want
    assert T.diameter(g, "none", local_edges=local_edges) == 0


def test_sweeps_by_numbers(spark, monkeypatch):
    monkeypatch.setattr(T, "distances", None)
    g = graph(spark, *PATH, "be", "xy")
    assert [T.diameter(g, v, local_edges=1) for v in ("b", "x", "none")] == [3, 1, 0] and vars(g)["_skein_numbers"].n == 7


@pytest.mark.parametrize("name", ["layer_metrics", "viewer_sizes", "top_betweenness", "viewer_search", "type_importance", "combined_rank", "master_frame"])
def test_tables_are_folded_once(spark, sf, monkeypatch, name):
    """Edges and types are folded and written once, and each graph of a query once before it is measured."""
    from skeinwork.plans import catalog
    from skeinwork.plans import graph_queries as Q

    folds, graphs = [], []
    signed, types, measure = Q.signed, Q.vertex_types, Z.betweenness
    monkeypatch.setattr(Q, "signed", lambda *x: folds.append("edges") or signed(*x))
    monkeypatch.setattr(Q, "vertex_types", lambda *x: folds.append("types") or types(*x))
    monkeypatch.setattr(Z, "betweenness", lambda edges, **x: graphs.append(edges) or measure(edges, **x))
    catalog.QUERIES[name](spark, sf)
    assert sorted(folds) == ["edges", "types"]
    assert graphs and not [f for g in graphs for f in g.inputFiles() if f.startswith(f"file://{sf}")]
