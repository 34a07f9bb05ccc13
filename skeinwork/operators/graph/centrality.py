"""PageRank and betweenness."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...scratch import Scratch
from ..joins import hot_values, shuffled, spread_join
from . import blocks, local
from .layers import both_ways, degrees
from .traversal import core_numbers

#: A graph of up to so many edges is numbered by Spark and sent to every task: 24 bytes an edge, 48 MB at most.
BROADCAST_EDGES = local.NUMBERED_EDGES
#: Edges that the searches of a task walk along at least, some seconds.
TASK_EDGES = 50_000_000
#: (source, vertex) pairs that the joins beyond keep at a time.
BLOCK_PAIRS = 200_000_000


def pagerank(edges: DataFrame, vertices: DataFrame | None = None, damping: float = 0.85, tolerance: float = 1e-9, look: int = 5, local_edges: int = local.LOCAL_EDGES) -> DataFrame:
    """(v, pagerank), iterated until the ranks change by no more than tolerance together; parallel edges count, mass of isolates goes to all.

    Ranks join the edges on the sender, hubs salted, and are summed before the shuffle. Every round is written, which cuts the lineage, and the change is looked at every few rounds.
    """
    if not vars(edges).get("_skein_numbers") and local.is_small(edges, local_edges):
        linked = both_ways(edges).select("v").distinct()
        alone = vertices.select("v").distinct().join(linked, "v", "left_anti") if vertices is not None else linked.limit(0)
        n_linked = linked.count()
        total = n_linked + alone.count()
        ranks = local.in_one_task(edges, "pagerank", T.DoubleType(), local.pagerank(damping, tolerance, total))
        return ranks.unionByName(alone.select("v", F.lit(_alone(damping, total, total - n_linked)).alias("pagerank")))
    if local_edges and (numbers := local.numbered(edges)):
        if vertices is None:
            return local.by_numbers(numbers, "pagerank", T.DoubleType(), local.pagerank(damping, tolerance))
        linked = both_ways(numbers.edges.toDF("a", "b", "m")).select(F.col("v").alias("id")).distinct()
        alone = vertices.select("v").distinct().join(shuffled(numbers.vertices.join(shuffled(linked), "id", "left_semi").select("v")), "v", "left_anti")
        n_alone = alone.count()
        total = linked.count() + n_alone
        ranks = local.by_numbers(numbers, "pagerank", T.DoubleType(), local.pagerank(damping, tolerance, total))
        return ranks.unionByName(alone.select("v", F.lit(_alone(damping, total, n_alone)).alias("pagerank")))
    scratch = Scratch(edges.sparkSession, "pagerank")
    d = degrees(edges).select("v", "degree")
    near = scratch.save(both_ways(edges).join(shuffled(d), "v").select("v", "w", (F.col("m") / F.col("degree")).alias("part")))
    hot = hot_values(near, "v", near.count())
    names = vertices.select("v").distinct() if vertices is not None else d.select("v")
    names = scratch.save(names.join(shuffled(d), "v", "left").select("v", F.col("degree").isNull().alias("alone")))
    n = names.count()
    if n == 0:
        return names.select("v", F.lit(0.0).alias("pagerank"))
    ranks = scratch.save(names.select("v", "alone", F.lit(1.0 / n).alias("r"), F.lit(1.0 / n).alias("was")))
    for k in itertools.count(1):
        sent = spread_join(near, ranks.select("v", "r"), "v", hot).groupBy(F.col("w").alias("v")).agg(F.sum(F.col("r") * F.col("part")).alias("got"))
        loose = ranks.agg(F.coalesce(F.sum(F.when(F.col("alone"), F.col("r"))), F.lit(0.0)).alias("loose"))  # one row
        new = (F.lit((1 - damping) / n) + damping * (F.coalesce("got", F.lit(0.0)) + F.col("loose") / n)).alias("r")
        after = scratch.save(ranks.join(shuffled(sent), "v", "left").crossJoin(F.broadcast(loose)).select("v", "alone", new, F.col("r").alias("was")))
        scratch.drop(ranks)
        ranks = after
        if k % look == 0 and ranks.agg(F.sum(F.abs(F.col("r") - F.col("was")))).first()[0] <= tolerance:
            return ranks.select("v", F.col("r").alias("pagerank"))


def _alone(damping: float, total: int, n_alone: int) -> float:
    """The rank of a vertex without edges, where it changes no more."""
    return (1 - damping) / (total - damping * n_alone) if total else 0.0


def betweenness(edges: DataFrame, collapse_parallel: bool = True, broadcast_edges: int = BROADCAST_EDGES) -> DataFrame:
    """(v, betweenness) of the vertices of edges, scaled to 0..1 for undirected graphs; 0 with fewer than three.

    All sources are used. Spark numbers the vertices; up to broadcast_edges edges, counted before, the numbers are split into biconnected blocks,
    which go to every task as arrays: trees are summed up without a search, and inside a large block a source searches around itself, up to where
    the ways by the block's hub are shorter; without such a hub the exact measure takes vertices times edges steps. The sources of all blocks are spread by what they cost, and every task sends one partial sum per vertex.
    Beyond, levels of all sources advance together by joins, in blocks of sources.
    """
    numbers = local.numbered(edges, broadcast_edges)
    if numbers is None:
        scratch = Scratch(edges.sparkSession, "betweenness")
        return _betweenness_by_joins(scratch.save(edges.select("a", "b", (F.lit(1) if collapse_parallel else F.col("m")).cast("bigint").alias("m"))), scratch)
    return numbers.vertices.join(shuffled(_sums(numbers, collapse_parallel)), "id").select("v", "betweenness")


def _sums(numbers: local.Numbered, collapse_parallel: bool) -> DataFrame:
    """(id, betweenness) of the vertices of edges."""
    spark = numbers.edges.sparkSession
    context = spark.sparkContext
    table = numbers.edges.toArrow()  # three numbers an edge, at most broadcast_edges of them
    a, b, m = (table[c].to_numpy() for c in ("x", "y", "m"))
    named, a, b = local.dense(a, b)
    n = len(named)
    graph = blocks.split(n, a, b, np.ones_like(m) if collapse_parallel else m)
    reached = np.cumsum(blocks.costs(graph))
    tasks = int(min(context.defaultParallelism * 4, 1 + (reached[-1] if len(reached) else 0) // TASK_EDGES))
    cuts = np.concatenate(([0], np.searchsorted(reached, reached[-1] * np.arange(1, tasks) / tasks), [len(reached)])) if len(reached) else np.zeros(2, dtype=np.int64)
    shared, scale = context.broadcast((graph, cuts, named)), float(max((n - 1) * (n - 2), 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for task in batch["id"]:
                g, at, named = shared.value
                score = np.bincount(g.vertex, blocks.dependencies(g, int(at[task]), int(at[task + 1])), minlength=len(named))
                ids = np.arange(len(named))
                if task == 0:  # has a row for each
                    score = score + g.base
                else:
                    ids = np.flatnonzero(score)
                yield pd.DataFrame({"id": named[ids], "score": score[ids]})

    sums = spark.range(0, tasks, 1, tasks).mapInPandas(run, "id bigint, score double")
    return sums.groupBy("id").agg((F.sum("score") / F.lit(scale)).alias("betweenness"))


def measures(edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-9) -> DataFrame:
    """(v, degree, betweenness, pagerank, core) of the vertices of edges, parallel ones as paths of their own.

    Where the graph is numbered, what one task solves comes from one task, and all of it is joined by numbers: names are joined once.
    """
    numbers = local.numbered(edges)
    if numbers is None:
        parts = degrees(edges).select("v", "degree"), betweenness(edges, collapse_parallel=False), pagerank(edges, None, damping, tolerance), core_numbers(edges)
        return reduce(lambda x, y: x.join(shuffled(y), "v"), parts)
    ranks = local.pagerank(damping, tolerance)

    def solve(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray, names: np.ndarray) -> dict[str, np.ndarray]:
        degree = np.bincount(a, m, minlength=n) + np.bincount(b, m, minlength=n)
        return {"degree": degree.astype(np.int64), "pagerank": ranks(n, a, b, m, names), "core": local.cores(n, a, b, m, names)}

    own = local.solved(numbers, {"degree": T.LongType(), "pagerank": T.DoubleType(), "core": T.LongType()}, solve)
    rows = numbers.vertices.join(shuffled(own.withColumnRenamed("_id", "id")), "id").join(shuffled(_sums(numbers, collapse_parallel=False)), "id")
    return rows.select("v", "degree", "betweenness", "pagerank", "core")


def _betweenness_by_joins(edges: DataFrame, scratch: Scratch, blocks: int | None = None, max_depth: int | None = None) -> DataFrame:
    """The same sums, for graphs too large for one task: (source, vertex) pairs of a block of sources, level by level.

    Levels go on until nothing new is reached; where max_depth is given and something lies beyond, it raises.
    """
    near = scratch.save(both_ways(edges))
    names = scratch.save(near.select("v").distinct())
    n = names.count()
    blocks = blocks or max(1, -(-n * n // BLOCK_PAIRS))  # a block holds about BLOCK_PAIRS pairs, however many vertices there are
    total = None
    for block in range(blocks):
        sources = names.filter(F.pmod(F.xxhash64("v"), F.lit(blocks)) == block)
        levels = [scratch.save(sources.select(F.col("v").alias("s"), "v", F.lit(1.0).alias("paths")))]
        seen = levels[0].select("s", "v")
        while True:
            step = levels[-1].join(shuffled(near), "v").groupBy("s", "w").agg(F.sum(F.col("paths") * F.col("m")).alias("paths")).withColumnRenamed("w", "v")
            fresh = scratch.save(step.join(shuffled(seen), ["s", "v"], "left_anti"))
            if fresh.isEmpty():
                break
            if max_depth is not None and len(levels) > max_depth:
                raise RuntimeError(f"vertices lie beyond {max_depth} steps of their source")
            levels.append(fresh)
            seen = scratch.save(seen.unionByName(fresh.select("s", "v")))
        need = levels[-1].select("s", "v", F.lit(0.0).alias("need"))
        parts = []
        for k in range(len(levels) - 1, 0, -1):
            below = levels[k].join(shuffled(need), ["s", "v"], "left").select("s", F.col("v").alias("w"), F.col("paths").alias("pw"), F.coalesce("need", F.lit(0.0)).alias("nw"))
            parts.append(below.select(F.col("w").alias("v"), F.col("nw").alias("score")))
            up = levels[k - 1].join(shuffled(near), "v").join(shuffled(below), ["s", "w"]).groupBy("s", "v").agg(F.sum(F.col("paths") * F.col("m") / F.col("pw") * (1 + F.col("nw"))).alias("need"))
            need = scratch.save(up)
        if parts:
            mine = parts[0]
            for p in parts[1:]:
                mine = mine.unionByName(p)
            mine = scratch.save(mine.groupBy("v").agg(F.sum("score").alias("score")))
            total = mine if total is None else scratch.save(total.unionByName(mine).groupBy("v").agg(F.sum("score").alias("score")))
    if total is None or n < 3:
        return names.withColumn("betweenness", F.lit(0.0))
    return names.join(shuffled(total), "v", "left").select("v", (F.coalesce("score", F.lit(0.0)) / F.lit(float((n - 1) * (n - 2)))).alias("betweenness"))
