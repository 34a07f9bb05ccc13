"""Components, distances, cores: iterations whose rounds are written to the shared folder."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...scratch import Scratch
from ..joins import hot_values, shuffled, spread_join
from . import local
from .layers import both_ways, degrees


def components(edges: DataFrame, local_edges: int = local.LOCAL_EDGES) -> DataFrame:
    """(v, component): the smallest vertex reachable from each vertex of an edge.

    Alternating stars: the larger neighbours of a vertex, then its smaller ones, are hung on the least of its neighbourhood.
    Rounds go on until nothing moves, logarithmically many in practice, whatever the diameter; minima aggregate before the shuffle, and the edges of hubs are salted.
    """
    if not vars(edges).get("_skein_numbers") and local.is_small(edges, local_edges):
        return local.in_one_task(edges.filter("a <> b"), "component", edges.schema["a"].dataType, local.components)
    if local_edges and (numbers := local.numbered(edges)):
        least = local.by_numbers(numbers, "id", T.LongType(), local.components)
        return least.join(shuffled(numbers.vertices.toDF("component", "id")), "id").select("v", "component")
    scratch = Scratch(edges.sparkSession, "components")
    now = scratch.save(edges.select("a", "b").filter("a <> b").distinct())
    vertices = both_ways(edges.select("a", "b", F.lit(1).alias("m"))).select("v").distinct()
    mark = None
    while True:
        near = now.union(now.select("b", "a")).toDF("v", "w")
        hot = hot_values(near, "v", near.count())
        least = near.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("m"))
        large = spread_join(near.filter("w > v"), least, "v", hot).filter("w <> m").select(F.col("m").alias("a"), F.col("w").alias("b"))
        large = scratch.save(large.union(least.filter("v <> m").select("m", "v")).distinct())
        down = large.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("w"))
        lowest = down.groupBy("v").agg(F.min("w").alias("m"))
        small = spread_join(down, lowest, "v", hot_values(down, "v", large.count())).filter("w <> m").select(F.col("m").alias("a"), F.col("w").alias("b"))
        after = scratch.save(small.union(lowest.select("m", "v")).distinct())
        scratch.drop(large)
        sign = tuple(after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        scratch.drop(now)
        now = after
        if sign == mark:
            break
        mark = sign
    return vertices.join(shuffled(now.select(F.col("b").alias("v"), F.col("a").alias("component"))), "v", "left").select("v", F.coalesce("component", "v").alias("component"))


def component_sizes(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(component, n_nodes, n_edges, density), edges with their multiplicity."""
    nodes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))
    links = edges.join(shuffled(labels.toDF("a", "component")), "a").groupBy("component").agg(F.sum("m").alias("n_edges"))
    n = F.col("n_nodes")
    return nodes.join(shuffled(links), "component").select("component", "n_nodes", "n_edges", F.round(2 * F.col("n_edges") / (n * (n - 1)), 6).alias("density"))


def largest_component(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges of the component with most nodes, the least label on a tie."""
    top = labels.groupBy("component").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "component").limit(1).select("component")
    return edges.join(shuffled(labels.join(F.broadcast(top), "component", "left_semi").select(F.col("v").alias("a"))), "a", "left_semi").select("a", "b", "m")


def distances(edges: DataFrame, start: str, max_depth: int | None = None, local_edges: int = local.LOCAL_EDGES) -> DataFrame:
    """(v, distance) of everything reachable from a vertex.

    The frontier alone is joined in each round, and what it reaches is compared with the last two levels only: the
    neighbours of a level are in it, in the one before, or new. Rounds go on until nothing new is reached; where max_depth is
    given and something lies beyond, it raises.
    """
    if not vars(edges).get("_skein_numbers") and local.is_small(edges, local_edges):
        return local.in_one_task(edges, "distance", T.IntegerType(), local.distances(start, max_depth))
    if local_edges and (numbers := local.numbered(edges)):
        at = numbers.vertices.filter(F.col("v") == start).first()
        return local.by_numbers(numbers, "distance", T.IntegerType(), local.distances(at["id"] if at else -1, max_depth))
    scratch = Scratch(edges.sparkSession, "distances")
    near = scratch.save(both_ways(edges).select("v", "w").distinct())
    levels = [scratch.save(near.filter(F.col("v") == start).select("v").distinct().withColumn("distance", F.lit(0)))]
    for depth in itertools.count(1):
        reached = near.join(shuffled(levels[-1].select("v")), "v").select(F.col("w").alias("v")).distinct()
        known = levels[-1].select("v") if depth == 1 else levels[-1].select("v").union(levels[-2].select("v"))
        fresh = scratch.save(reached.join(shuffled(known), "v", "left_anti").withColumn("distance", F.lit(depth)))
        if fresh.isEmpty():
            break
        if max_depth is not None and depth > max_depth:
            raise RuntimeError(f"vertices lie beyond {max_depth} steps of the start")
        levels.append(fresh)
    return scratch.read_all(*levels)


def pseudo_diameter(edges: DataFrame, start: str) -> int:
    """Greatest distance found by sweeping from the farthest vertex, until it grows no more."""
    best = -1
    while True:
        far = distances(edges, start).orderBy(F.desc("distance"), "v").first()
        if far is None or far["distance"] <= best:
            return max(best, 0)
        best, start = far["distance"], far["v"]


def diameter(edges: DataFrame, start: str, local_edges: int = local.LOCAL_EDGES) -> int:
    """As pseudo_diameter; of a graph that one task solves, that task makes all the sweeps."""
    if not vars(edges).get("_skein_numbers") and local.is_small(edges, local_edges):
        found = local.in_one_task(edges, "far", T.IntegerType(), local.diameter(start)).first()
        return found["far"] if found else 0
    if local_edges and (numbers := local.numbered(edges)):
        at = numbers.vertices.filter(F.col("v") == start).first()
        found = local.by_numbers(numbers, "far", T.IntegerType(), local.diameter(at["id"])).first() if at else None
        return found["far"] if found else 0
    return pseudo_diameter(edges, start)


def core_numbers(edges: DataFrame, local_edges: int = local.LOCAL_EDGES) -> DataFrame:
    """(v, core) on distinct neighbours: the largest k of a subgraph in which all have k neighbours.

    Every vertex takes the h-index of its neighbours' values, from their degrees on, until none changes, however many rounds that takes. Values above its own
    count as its own, so a hub has as many rows as its core is high, not as it has neighbours.
    """
    if not vars(edges).get("_skein_numbers") and local.is_small(edges, local_edges):
        return local.in_one_task(edges, "core", T.LongType(), local.cores)
    if local_edges and (numbers := local.numbered(edges)):
        return local.by_numbers(numbers, "core", T.LongType(), local.cores)
    scratch = Scratch(edges.sparkSession, "cores")
    near = scratch.save(both_ways(edges).select("v", "w"))
    now = scratch.save(degrees(edges).select("v", F.col("neighbours").alias("core")))
    hot = hot_values(near, "v", near.count())
    while True:
        seen = spread_join(spread_join(near, now.toDF("w", "theirs"), "w", hot), now, "v", hot).groupBy("v", "core", F.least("theirs", "core").alias("x")).agg(F.count(F.lit(1)).alias("n"))
        above = F.sum("n").over(Window.partitionBy("v").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0))
        after = scratch.save(seen.withColumn("above", above).groupBy("v").agg(F.max(F.least("x", "above")).alias("core")))
        settled = after.join(shuffled(now.toDF("v", "was")), "v").filter("core <> was").isEmpty()
        scratch.drop(now)
        now = after
        if settled:
            return now


def core_composition(cores: DataFrame, types: DataFrame) -> DataFrame:
    """(core, type, n, share, offset): types within each shell, and the share of the types before it in order of name."""
    rows = cores.join(types, "v", "left").groupBy("core", F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count(F.lit(1)).alias("n"))
    shell = Window.partitionBy("core")
    rows = rows.withColumn("part", F.col("n") / F.sum("n").over(shell))
    before = F.coalesce(F.sum("part").over(shell.orderBy("type").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return rows.select("core", "type", "n", F.round("part", 6).alias("share"), F.round(before, 6).alias("offset"))
