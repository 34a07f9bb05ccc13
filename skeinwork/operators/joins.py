"""Joins of tables that grow: nothing is broadcast by an estimate, and hot keys are spread over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks that share the rows of a hot key.
SALTS = 64
#: A side is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 100_000


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: the join shuffles and sorts, whatever Spark estimates."""
    return df.hint("merge")


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast if a count finds at most limit rows (it stops above them), else shuffled."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else shuffled(df)


def hot_values(df: DataFrame, key: str, rows: int, least: int = 10_000, share: int = 1_000) -> list:
    """Values of key in more than `least` rows and more than a `share`-th of all rows: never more than `share` values."""
    if rows <= least:
        return []
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(least, rows // share))
    return [r[0] for r in counts.select(key).collect() if r[0] is not None]


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: list, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """left joined with right on key, by a shuffle. Rows of left under a hot value go to `salts` tasks, and so do its rows of right.

    how is inner, left, left_semi or left_anti. The columns are those of a join on a named key.
    """
    if not hot:
        return left.join(shuffled(right), key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    salted = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0)))
    copies = right.withColumn("_salt", F.explode(F.when(is_hot, F.expr(f"sequence(0L, {salts - 1}L)")).otherwise(F.expr("array(0L)"))))
    return salted.join(shuffled(copies), [key, "_salt"], how).drop("_salt")
