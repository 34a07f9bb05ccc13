"""Counts, shares, top lists and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """(value, n, share): rows per value; the share is of all rows. As many rows as there are distinct values."""
    counts = df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select(name, "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def endpoint_degree(edges: DataFrame, source: Column, target: Column) -> DataFrame:
    """(name, n): how often each name is an end of an edge."""
    return edges.select(F.explode(F.array(source, target)).alias("name")).filter("name <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of a total order; Spark keeps k rows per task and merges them."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """The first k rows of each group with their rank; the rank limit is applied inside the tasks before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= k)


def array_sizes(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, rows with any, and least, largest and mean size of an array column."""
    size = F.size(F.coalesce(F.col(column), F.array().cast("array<string>")))
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(size > 0).alias("n_with"), F.round(F.avg((size > 0).cast("int")), 6).alias("coverage"),
        F.min(size).alias("min_size"), F.max(size).alias("max_size"), F.round(F.avg(size), 6).alias("mean_size"),
    )


def edge_shares(edges: DataFrame, kind: str) -> DataFrame:
    """(kind, n, infobox_share, multi_source_share): parts of edges told by infoboxes only, and by two sources or more.

    An edge without texts counts as told by infoboxes only, as all of none do.
    """
    infobox = F.forall("descriptions", lambda d: F.contains(F.lower(d), F.lit("infobox")))
    return edges.groupBy(kind).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(infobox.cast("int")), 6).alias("infobox_share"), F.round(F.avg((F.size("sources") >= 2).cast("int")), 6).alias("multi_source_share")
    )


def exploded_counts(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """(value, n) over the members of an array column."""
    return df.select(F.explode(column).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def scaled(df: DataFrame, metric: str, least: float = 1.0, span: float = 10.0) -> DataFrame:
    """size: least plus span times the metric's place between its extremes, whose distance is taken one larger."""
    ends = df.agg(F.min(metric).alias("_lo"), F.max(metric).alias("_hi"))  # one row
    return df.crossJoin(F.broadcast(ends)).withColumn("size", F.round(least + span * (F.col(metric) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1), 6)).drop("_lo", "_hi")


def keep_first(df: DataFrame, key: list[Column], order: Column, pass_null: bool = True) -> DataFrame:
    """The first row of each key; rows whose key is null are all kept if pass_null."""
    keyed = df.withColumn("_k", F.concat_ws("\t", *key)).withColumn("_null", F.greatest(*[k.isNull().cast("int") for k in key]) == 1 if len(key) > 1 else key[0].isNull())
    row = F.struct(*[F.col(c) for c in df.columns])
    firsts = keyed.filter("not _null").groupBy("_k").agg(F.min_by(row, order).alias("r")).select("r.*")
    return firsts.unionByName(keyed.filter("_null").select(*df.columns)) if pass_null else firsts
