"""Problem 2: consolidate pairwise matches into groups by low-diameter decomposition.

Every vertex draws an exponentially distributed head start from a hash of its id, so a rerun after a lost executor
draws the same. Clusters grow along the edges from those shifted start times: a vertex joins the centre u that maximises
head start(u) - distance(u, vertex). Growth is cut after a few steps; a vertex then has a label of its own component
whether or not the cluster grew to its end, so contraction stays right and only the number of levels changes. Clusters
contract to super-vertices, the edges between clusters recurse, and the assignments are composed from the top down.
With an expected constant share of edges inside clusters, levels are logarithmic in the edges, whatever the diameter.

Equal names link through stars to a small member, never through all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import fold_name, is_absent
from ..operators.graph import local
from ..operators.joins import bounded, hot_values, shuffled, spread_join
from ..scratch import Scratch

_SALTS = 64
#: The recursion ends with a contracted graph of so many edges, counted, which one task of an executor solves: some megabytes.
BASE_EDGES = 20_000


def shared_key_edges(keys: DataFrame, salts: int = _SALTS) -> DataFrame:
    """Edges (a, b) that link all ids under an equal key, from rows (id, key).

    Two stars: to the smallest id of (key, salt), and from there to the smallest id of the key. Both minima are built
    with partial aggregation, and the join that carries them back is on (key, salt), so a key that a third of all rows
    hold is spread over `salts` tasks. Null keys and null ids link nothing.
    """
    rows = keys.select("id", "key").filter("id is not null and key is not null").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    near = rows.groupBy("key", "salt").agg(F.min("id").alias("near"))
    far = near.groupBy("key").agg(F.min("near").alias("far"))
    inner = rows.join(shuffled(near), ["key", "salt"]).select(F.col("id").alias("a"), F.col("near").alias("b"))
    outer = near.join(shuffled(far), "key").select(F.col("near").alias("a"), F.col("far").alias("b"))
    return inner.unionByName(outer).filter("a <> b")


def _head_start(vertex: str, level: str, beta: float):
    u = (F.shiftrightunsigned(F.xxhash64(vertex, level), 11) + 1) / F.lit(float(2**53))
    return -F.log(u) / F.lit(beta)


def simple_edges(edges: DataFrame, level: int = 0) -> DataFrame:
    """(a, b, level), a < b, each edge once; self pairs and null ends fall away."""
    a, b = F.least("a", "b"), F.greatest("a", "b")
    return edges.filter("a is not null and b is not null and a <> b").select(a.alias("a"), b.alias("b"), F.lit(level).alias("level")).distinct()


def decompose(level_edges: DataFrame, n: int, scratch: Scratch, beta: float = 0.1, steps: int = 3) -> tuple[DataFrame, DataFrame]:
    """One level over n simple edges: (id, up), the cluster of every vertex, and the edges between clusters as those of the next level."""
    # the number of the level is a column, so the code of every level is the same and compiled once
    both = level_edges.union(level_edges.select("b", "a", "level")).toDF("v", "w", "level")
    hot = hot_values(both, "w", 2 * n)
    own = both.groupBy("v").agg(F.first("level").alias("level"))
    # a vertex reaches itself in no step, its neighbours in one
    sends = both.select("v", "w", F.lit(1).alias("step")).union(own.select("v", F.col("v").alias("w"), F.lit(0).alias("step")))
    labels = own.select(F.col("v").alias("w"), _head_start("v", "level", beta).alias("t"), F.col("v").alias("c"))
    for _ in range(steps):
        sent = spread_join(sends, labels, "w", hot).select("v", (F.col("t") - F.col("step")).alias("t"), "c")
        labels = sent.groupBy(F.col("v").alias("w")).agg(F.max_by("c", "t").alias("c"), F.max("t").alias("t")).select("w", "t", "c")
    assigned = scratch.save(labels.select(F.col("w").alias("id"), F.col("c").alias("up")))
    left = spread_join(spread_join(level_edges, assigned.toDF("a", "x"), "a", hot), assigned.toDF("b", "y"), "b", hot).filter("x <> y")
    return assigned, scratch.save(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (F.col("level") + 1).alias("level")).distinct())


def settle(level_edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The end of the recursion: (id, up) with the smallest vertex of each component as up, and no edges."""
    found = local.in_one_task(level_edges.select("a", "b", F.lit(1).alias("m")), "up", level_edges.schema["a"].dataType, local.components)
    return scratch.save(found.toDF("id", "up")), scratch.save(level_edges.limit(0))


def low_diameter_groups(edges: DataFrame, beta: float = 0.1, steps: int = 3, base: int = BASE_EDGES) -> DataFrame:
    """(id, group_id) for every vertex of edges (a, b); group_id is the smallest id of its connected component.

    Repeated edges, either orientation, and self pairs are allowed; a null end drops the edge. An empty table gives an
    empty result. Other columns are ignored. Each level is written to the shared folder, and what it replaces is deleted.
    Levels go on until no edge is left; a contracted graph of at most `base` edges ends the recursion in one task. Numbers as ids keep every aggregation in hash tables; other types sort.
    """
    scratch = Scratch(edges.sparkSession, "groups")
    level_edges = scratch.save(simple_edges(edges))
    levels: list[DataFrame] = []
    while n := level_edges.count():
        assigned, contracted = decompose(level_edges, n, scratch, beta, steps) if not levels or n > base else settle(level_edges, scratch)
        levels.append(assigned)
        scratch.drop(level_edges)
        level_edges = contracted
    if not levels:
        return level_edges.select(F.col("a").alias("id"), F.col("a").alias("group_id"))
    # compose from the top: a centre that is no vertex of the next level is a root
    up = levels.pop()
    while levels:
        below = levels.pop()
        up = spread_join(below, up.toDF("up", "root"), "up", hot_values(below, "up", below.count()), "left").select("id", F.coalesce("root", "up").alias("up"))
    roots = scratch.save(up)
    smallest = roots.groupBy("up").agg(F.min("id").alias("group_id"))
    return spread_join(roots, smallest, "up", hot_values(roots, "up", roots.count())).select("id", "group_id")


def node_links(nodes: DataFrame, matches: DataFrame, generic: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes that share a usable name, or that a review called the same."""
    named = nodes.select(
        F.col("node_id").alias("id"),
        F.explode(F.array_distinct(F.transform(F.concat(F.array("standard_name"), F.coalesce("aliases", F.array().cast("array<string>"))), fold_name))).alias("key"),
    )
    names = generic.select(fold_name(F.col("name")).alias("key")).filter("key is not null").distinct()
    usable = named.filter(~is_absent(F.col("key"))).join(bounded(names), "key", "left_anti")
    ids = nodes.select(F.col("node_id").alias("id")).filter("id is not null").distinct()
    same = (
        matches.filter("verdict = 'same'").select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
        .join(shuffled(ids.toDF("a")), "a", "left_semi").join(shuffled(ids.toDF("b")), "b", "left_semi")
    )
    return shared_key_edges(usable).unionByName(same.select("a", "b"))


def node_groups(nodes: DataFrame, matches: DataFrame, generic: DataFrame) -> DataFrame:
    """(node_id, group_id) for every node; a node without links is a group of its own.

    Null node ids are left out, repeated rows count once, null and empty alias lists and blank names link nothing,
    and an empty table gives an empty result. Columns beside the named ones are ignored.
    """
    grouped = low_diameter_groups(node_links(nodes, matches, generic)).withColumnRenamed("id", "node_id")
    ids = nodes.select("node_id").filter("node_id is not null").distinct()
    return ids.join(shuffled(grouped), "node_id", "left").select("node_id", F.coalesce("group_id", "node_id").alias("group_id"))


def groups_found(groups: DataFrame) -> DataFrame:
    """The rows of groups of two or more: the members that are not the smallest id, and the smallest ids that such a member names."""
    others = groups.filter("node_id <> group_id")
    return others.select("node_id", "group_id").union(others.select("group_id").distinct().select("group_id", "group_id"))
