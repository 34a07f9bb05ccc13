"""Triangles, clustering, and assortative mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layers import both_ways, degrees


def triangles(edges: DataFrame) -> DataFrame:
    """(v, n): triangles at each vertex that has one.

    Every edge points from the end of lower degree (then name) to the other, so no vertex points to more than the square root of
    twice the number of edges, and a hub does not multiply its neighbours with each other.
    """
    d = degrees(edges).select("v", F.col("neighbours").alias("d"))
    rows = edges.select("a", "b").join(d.toDF("a", "da"), "a").join(d.toDF("b", "db"), "b")
    up = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    out = rows.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("y"))
    wedges = out.toDF("x", "y").join(out.toDF("x", "z"), "x").filter("y < z")
    closed = wedges.join(edges.select(F.col("a").alias("y"), F.col("b").alias("z")), ["y", "z"])
    return closed.select(F.explode(F.array("x", "y", "z")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def local_clustering(edges: DataFrame) -> DataFrame:
    """(v, neighbours, triangles, clustering) of vertices with two neighbours or more."""
    rows = degrees(edges).filter("neighbours >= 2").join(triangles(edges), "v", "left").withColumn("triangles", F.coalesce("n", F.lit(0)))
    return rows.select("v", "neighbours", "triangles", F.round(2 * F.col("triangles") / (F.col("neighbours") * (F.col("neighbours") - 1)), 6).alias("clustering"))


def clustering_summary(edges: DataFrame) -> DataFrame:
    """One row: transitivity, and the mean local clustering of vertices with two neighbours or more."""
    rows = degrees(edges).filter("neighbours >= 2").join(triangles(edges), "v", "left").select("neighbours", F.coalesce("n", F.lit(0)).alias("n"))
    pairs = F.col("neighbours") * (F.col("neighbours") - 1) / 2
    return rows.agg(F.round(F.try_divide(F.sum("n"), F.sum(pairs)), 6).alias("transitivity"), F.round(F.avg(F.col("n") / pairs), 6).alias("mean_local_clustering"))


def degree_assortativity(edges: DataFrame) -> DataFrame:
    """One row: correlation of the degrees at the two ends of edges, in both orientations; parallel edges count."""
    d = degrees(edges).select("v", F.col("degree").cast("double").alias("d"))
    rows = both_ways(edges).join(d.toDF("v", "x"), "v").join(d.toDF("w", "y"), "w")
    n, xy, x, xx = F.sum("m"), F.sum(F.col("m") * F.col("x") * F.col("y")), F.sum(F.col("m") * F.col("x")), F.sum(F.col("m") * F.col("x") * F.col("x"))
    return rows.agg(F.round(F.try_divide(xy / n - (x / n) * (x / n), xx / n - (x / n) * (x / n)), 6).alias("degree_assortativity"))


def mixing(edges: DataFrame, types: DataFrame) -> DataFrame:
    """(type_a, type_b, n, share) over both orientations of all edges. types: (v, type); a vertex without one is unknown."""
    rows = both_ways(edges).join(types.toDF("v", "type_a"), "v", "left").join(types.toDF("w", "type_b"), "w", "left")
    cells = rows.groupBy(F.coalesce("type_a", F.lit("unknown")).alias("type_a"), F.coalesce("type_b", F.lit("unknown")).alias("type_b")).agg(F.sum("m").alias("n"))
    total = cells.agg(F.sum("n").alias("total"))  # one row
    return cells.crossJoin(F.broadcast(total)).select("type_a", "type_b", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def type_assortativity(edges: DataFrame, types: DataFrame) -> DataFrame:
    """One row: Newman's coefficient for types; 0 for a graph without edges, 1 where only one type occurs."""
    cells = mixing(edges, types)
    row = cells.groupBy("type_a").agg(F.sum("n").alias("a"), F.sum(F.when(F.col("type_a") == F.col("type_b"), F.col("n")).otherwise(0)).alias("own"))
    total, own = F.sum("a"), F.sum("own")
    expected = F.sum(F.col("a").cast("double") * F.col("a")) / (total * total)
    r = F.when(F.coalesce(total, F.lit(0)) == 0, 0.0).when(F.count(F.lit(1)) == 1, 1.0).otherwise((own / total - expected) / (1 - expected))
    return row.agg(F.round(r, 6).alias("type_assortativity"))
