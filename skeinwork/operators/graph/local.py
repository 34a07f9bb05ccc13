"""Graphs of a counted, small size in one task.

The rounds of the distributed operators cost a job each, which is all they cost on a small graph. Up to LOCAL_EDGES edges,
counted before, the edges go to one task as arrays and come back as one value per vertex; results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...scratch import Scratch
from ..joins import shuffled
from .layers import both_ways, positions

#: 200,000 edges are some 20 MB with their names.
LOCAL_EDGES = 200_000
#: A graph of up to so many edges is numbered by Spark and handled as numbers: 24 bytes an edge, 48 MB at most.
NUMBERED_EDGES = 2_000_000


def is_small(edges: DataFrame, limit: int) -> bool:
    """Whether a frame has at most limit rows; counting stops above it."""
    return limit > 0 and edges.limit(limit + 1).count() <= limit


def in_one_task(edges: DataFrame, value: str, kind: T.DataType, solve: Callable[[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(v, value): solve(n, a, b, m, names) on vertex numbers in the order of their names; rows whose value is None are left out."""
    schema = T.StructType([T.StructField("v", edges.schema["a"].dataType), T.StructField(value, kind)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        table = pd.concat(parts)
        names, codes = np.unique(np.concatenate((table["a"].to_numpy(object), table["b"].to_numpy(object))), return_inverse=True)
        size = len(table)
        out = pd.DataFrame({"v": names, value: solve(len(names), codes[:size], codes[size:], table["m"].to_numpy(), names)})
        yield out[out[value].notna()]

    return edges.select("a", "b", "m").coalesce(1).mapInPandas(run, schema)


@dataclass
class Numbered:
    """A graph by numbers: (v, id) in the order of the names, which may be those of a larger graph that holds it, (x, y, m) of the edges, and how many there are of both."""

    vertices: DataFrame
    edges: DataFrame
    n: int
    size: int


def dense(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers that occur, in order, and the ends of edges by their position there."""
    ids, codes = np.unique(np.concatenate((a, b)), return_inverse=True)
    return ids, codes[: len(a)], codes[len(a) :]


def numbered(edges: DataFrame, limit: int = NUMBERED_EDGES) -> Numbered | None:
    """The numbers of a graph of at most limit edges, written once for all that ask for the same frame; none beyond."""
    kept = vars(edges).get("_skein_numbers")
    if kept is None:
        scratch = Scratch(edges.sparkSession, "numbers")
        rows = vars(edges).get("_skein_rows")
        if rows is None:
            edges._skein_rows = rows = scratch.save(edges.select("a", "b", F.col("m").cast("bigint").alias("m")))
        size = rows.count()
        if size > limit:
            return None
        names = scratch.save(both_ways(rows).select("v").distinct())
        n = names.count()
        listed = scratch.save(numbers_of(names, n))
        ends = scratch.save(rows.join(shuffled(listed.toDF("a", "x")), "a").join(shuffled(listed.toDF("b", "y")), "b").select("x", "y", "m"))
        edges._skein_numbers = kept = Numbered(listed, ends, n, size)
    return kept if kept.size <= limit else None


def numbers_of(names: DataFrame, n: int) -> DataFrame:
    """The n rows of distinct names v with their id, from 0 on in the order of the names."""
    return positions(names, {"v": "last"}, "v").withColumn("id", n - F.col("last")).drop("last")


def by_numbers(graph: Numbered, value: str, kind: T.DataType, solve: Callable[[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(v, value): as in_one_task, the numbers standing for the names."""
    by_id = solved(graph, {value: kind}, lambda *x: {value: solve(*x)})
    return graph.vertices.toDF("v", "_id").join(shuffled(by_id), "_id").select("v", value)


def solved(graph: Numbered, kinds: dict[str, T.DataType], solve: Callable[[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> DataFrame:
    """(_id, a column for each of kinds), all from one task; rows in which a value is None are left out."""
    schema = T.StructType([T.StructField("_id", T.LongType()), *(T.StructField(c, kind) for c, kind in kinds.items())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            a, b, m = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("x", "y", "m"))
            ids, a, b = dense(a, b)
            yield pd.DataFrame({"_id": ids} | solve(len(ids), a, b, m, ids)).dropna()

    return graph.edges.coalesce(1).mapInPandas(run, schema)


def components(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The name of the smallest vertex reachable from each."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return names[label]
        label = new


def cores(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Core numbers on distinct neighbours, by h-indices."""
    v, w = np.concatenate((a, b)), np.concatenate((b, a))
    core = np.bincount(v, minlength=n)
    while True:
        theirs = core[w]
        order = np.lexsort((-theirs, v))
        first = np.concatenate(([0], np.cumsum(np.bincount(v, minlength=n))))[:-1]
        place = np.arange(len(v)) - first[v[order]] + 1
        new = np.zeros(n, dtype=core.dtype)
        np.maximum.at(new, v[order], np.minimum(theirs[order], place))
        if (new == core).all():
            return core
        core = new


def distances(start: str | int, max_depth: int | None = None) -> Callable[..., np.ndarray]:
    """Steps from a named vertex; none where it does not reach. An error where something lies beyond max_depth."""

    def solve(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray, names: np.ndarray) -> np.ndarray:
        far = np.full(n, -1)
        far[names == start] = 0
        for step in range(n):
            out = np.concatenate((b[far[a] == step], a[far[b] == step]))
            fresh = out[far[out] < 0]
            if not len(fresh):
                break
            if max_depth is not None and step >= max_depth:
                raise RuntimeError(f"vertices lie beyond {max_depth} steps of the start")
            far[fresh] = step + 1
        return np.where(far < 0, None, far)

    return solve


def diameter(start: str | int) -> Callable[..., np.ndarray]:
    """The greatest distance that sweeps from the farthest vertex find, told at the start alone; none where it is no vertex."""

    def solve(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray, names: np.ndarray) -> np.ndarray:
        out = np.full(n, None)
        v, w = np.concatenate((a, b)), np.concatenate((b, a))
        near, first = w[np.argsort(v, kind="stable")], np.concatenate(([0], np.cumsum(np.bincount(v, minlength=n))))
        at = here = np.flatnonzero(names == start)
        best = -1
        while len(at):
            level, seen, steps = at[:1], np.zeros(n, dtype=bool), 0
            seen[level] = True
            while True:
                sizes = first[level + 1] - first[level]
                reached = near[np.repeat(first[level] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                reached = np.unique(reached[~seen[reached]])
                if not len(reached):
                    break
                seen[reached], level, steps = True, reached, steps + 1
            if steps <= best:
                break
            best, at = steps, level  # in the order of the names
        out[here] = best
        return out

    return solve


def pagerank(damping: float, tolerance: float, among: int | None = None) -> Callable[..., np.ndarray]:
    """Ranks among so many vertices, of which those without an edge are not here: they share one rank. None: all are here."""

    def solve(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray, names: np.ndarray) -> np.ndarray:
        total = among or n
        v, w, k = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((m, m))
        part = k / np.bincount(v, k, minlength=n)[v]
        rank, alone, change = np.full(n, 1.0 / total), 1.0 / total, 1.0
        while change > tolerance:
            base = (1 - damping) / total + damping * alone * (total - n) / total
            new = base + damping * np.bincount(w, rank[v] * part, minlength=n)
            change = np.abs(new - rank).sum() + abs(base - alone) * (total - n)
            rank, alone = new, base
        return rank

    return solve
