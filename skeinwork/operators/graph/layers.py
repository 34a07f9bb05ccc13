"""Layers of a signed graph and what degrees tell of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...scratch import Scratch


def layer(edges: DataFrame, relationship: str | None = None, source: str = "source", target: str = "target", key: Column | None = None) -> DataFrame:
    """(a, b, m) of one relationship, or of all: self-loops skipped, direction forgotten, parallel edges counted."""
    rows = edges.filter(F.col("relationship") == relationship) if relationship else edges
    rows = rows.filter((F.col(source) != "") & (F.col(target) != "") & (F.col(source) != F.col(target)))
    return rows.groupBy(F.least(source, target).alias("a"), F.greatest(source, target).alias("b")).agg(F.count(F.lit(1)).alias("m"))


def both_ways(edges: DataFrame) -> DataFrame:
    """(v, w, m) in either direction."""
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w")))).alias("e"), "m").select("e.v", "e.w", "m")


def degrees(edges: DataFrame) -> DataFrame:
    """(v, degree, neighbours): edges with and without multiplicity."""
    return both_ways(edges).groupBy("v").agg(F.sum("m").alias("degree"), F.count(F.lit(1)).alias("neighbours"))


def isolates(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices (v) without an edge."""
    return vertices.join(both_ways(edges).select("v").distinct(), "v", "left_anti")


def degree_summary(edges: DataFrame) -> DataFrame:
    """One row: n_nodes, n_edges, density, mean, median and maximum degree."""
    d = degrees(edges)
    n, e = F.count(F.lit(1)), F.sum("degree") / 2
    return d.agg(
        n.alias("n_nodes"), F.coalesce(e, F.lit(0.0)).cast("bigint").alias("n_edges"),
        F.round(F.when(n > 1, F.sum("degree") / (n * (n - 1))).otherwise(0.0), 6).alias("density"),
        F.round(F.avg("degree"), 6).alias("mean_degree"), F.median("degree").alias("median_degree"), F.max("degree").alias("max_degree"),
    )


def signed_degrees(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """(v, d_pos, d_neg, total, difference, product) over distinct neighbours of two layers."""
    p = degrees(positive).select("v", F.col("neighbours").alias("d_pos"))
    n = degrees(negative).select("v", F.col("neighbours").alias("d_neg"))
    j = p.join(n, "v", "full").select("v", F.coalesce("d_pos", F.lit(0)).alias("d_pos"), F.coalesce("d_neg", F.lit(0)).alias("d_neg"))
    return j.withColumns({"total": F.col("d_pos") + F.col("d_neg"), "difference": F.col("d_pos") - F.col("d_neg"), "product": F.col("d_pos") * F.col("d_neg")})


def contradictory(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Pairs that are edges of both layers."""
    return positive.select("a", "b").intersect(negative.select("a", "b"))


def both_layers(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Vertices with an edge in either layer (v)."""
    return both_ways(positive).select("v").union(both_ways(negative).select("v")).distinct()


def positions(df: DataFrame, metrics: dict[str, str], name: str = "v") -> DataFrame:
    """Ordinal ranks by descending metrics, ties by name, nulls last: metrics maps metric column to rank column.

    A row number over all rows would be one sorted partition. Rows are parted by ranges of (metric, name) instead, so that
    even a value that most rows share is split, written with the number of their range, and numbered inside it; the sizes
    of the ranges before are added.
    """
    scratch = Scratch(df.sparkSession, "positions")
    for metric, rank in metrics.items():
        order = (F.desc(metric), F.asc(name))
        ranged = scratch.save(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
        sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # as many rows as partitions
        base = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_base"))
        inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
        df = ranged.withColumn("_w", inside).join(F.broadcast(base), "_part").withColumn(rank, (F.col("_base") + F.col("_w")).cast("bigint")).drop("_part", "_w", "_base")
    return df


def rank_changes(first: DataFrame, second: DataFrame, metric: str) -> DataFrame:
    """(v, rank_1, rank_2, delta, max_rank) of vertices in both layers whose metric is above 0 in one of them."""
    both = first.select("v", F.col(metric).alias("m1")).join(second.select("v", F.col(metric).alias("m2")), "v").filter("m1 > 0 or m2 > 0")
    ranked = positions(both, {"m1": "rank_1", "m2": "rank_2"})
    return ranked.select("v", "rank_1", "rank_2", (F.col("rank_2") - F.col("rank_1")).alias("delta"), F.greatest("rank_1", "rank_2").alias("max_rank"))


def ego(edges: DataFrame, name: str) -> DataFrame:
    """The edges of one vertex and those among its neighbours."""
    near = both_ways(edges).filter(F.col("v") == name).select("w")
    within = F.broadcast(near.union(near.sparkSession.createDataFrame([(name,)], "w string")).distinct()) if near.limit(100_001).count() <= 100_000 else near.union(near.sparkSession.createDataFrame([(name,)], "w string")).distinct()
    return edges.join(within.toDF("a"), "a", "left_semi").join(within.toDF("b"), "b", "left_semi").select("a", "b", "m")
