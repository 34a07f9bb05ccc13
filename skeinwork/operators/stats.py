"""Group statistics, bootstraps and tests."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def importance(df: DataFrame, group: str, metrics: list[str]) -> DataFrame:
    """Per group: n, and mean, sample deviation, standard error and sum of each metric; deviation null for one row."""
    out: list[Column] = [F.count(F.lit(1)).alias("n")]
    for m in metrics:
        out += [
            F.round(F.avg(m), 6).alias(f"{m}_mean"), F.round(F.stddev_samp(m), 6).alias(f"{m}_std"),
            F.round(F.stddev_samp(m) / F.sqrt(F.count(F.lit(1))), 6).alias(f"{m}_se"), F.round(F.sum(m), 6).alias(f"{m}_sum"),
        ]
    return df.groupBy(group).agg(*out)


def alliance_share(signed: DataFrame, types: DataFrame) -> DataFrame:
    """(type, n, d_pos, d_neg, share): positive part of all signed edges of a type's organisations."""
    rows = signed.join(types, "v", "left").withColumn("type", F.coalesce("type", F.lit("unknown"))).filter("total > 0")
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("d_pos").alias("d_pos"), F.sum("d_neg").alias("d_neg"), F.round(F.sum("d_pos") / F.sum("total"), 6).alias("share"))


def alliance_share_interval(signed: DataFrame, types: DataFrame, replicates: int = 2000, seed: int = 42, least: int = 10) -> DataFrame:
    """(type, n, ci_lo, ci_hi): percentile bootstrap over organisations, types of fewer than `least` left out.

    Resampling organisations is drawing how often each distinct (d_pos, d_neg) comes, so a type is reduced to the counts of
    its distinct degree pairs before anything is drawn. Each type has its own stream from the seed.
    """
    rows = signed.join(types, "v", "left").withColumn("type", F.coalesce("type", F.lit("unknown"))).filter("total > 0")
    cells = rows.groupBy("type", "d_pos", "d_neg").agg(F.count(F.lit(1)).alias("k"))
    enough = cells.groupBy("type").agg(F.sum("k").alias("n")).filter(F.col("n") >= least).select("type")
    cells = cells.join(enough, "type", "left_semi")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        n, kind = int(pdf["k"].sum()), pdf["type"].iloc[0]
        pdf = pdf.sort_values(["d_pos", "d_neg"])
        rng = np.random.default_rng([seed, zlib.crc32(kind.encode())])
        drawn = rng.multinomial(n, pdf["k"].to_numpy() / n, size=replicates)
        pos, neg = drawn @ pdf["d_pos"].to_numpy(), drawn @ pdf["d_neg"].to_numpy()
        share = np.where(pos + neg > 0, pos / np.maximum(pos + neg, 1), np.nan)
        lo, hi = np.nanpercentile(share, [2.5, 97.5])
        return pd.DataFrame({"type": [kind], "n": [n], "ci_lo": [round(float(lo), 6)], "ci_hi": [round(float(hi), 6)]})

    return cells.groupBy("type").applyInPandas(draw, "type string, n bigint, ci_lo double, ci_hi double")


def bootstrap_assortativity(cells: DataFrame, replicates: int = 1000, seed: int = 42) -> DataFrame:
    """(layer, mean, se) of type assortativity over resampled edges. cells: (layer, type_a, type_b, n), each edge once.

    Resampling edges is a multinomial draw over the cells of the mixing matrix, which is all that is needed of the graph.
    """

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["type_a", "type_b"])
        kinds = {t: i for i, t in enumerate(sorted({*pdf["type_a"], *pdf["type_b"]}))}
        n, k = int(pdf["n"].sum()), len(kinds)
        rng = np.random.default_rng([seed, zlib.crc32(pdf["layer"].iloc[0].encode())])
        drawn = rng.multinomial(n, pdf["n"].to_numpy() / n, size=replicates)
        e = np.zeros((replicates, k, k))
        for c, (a, b) in enumerate(zip(pdf["type_a"], pdf["type_b"])):
            e[:, kinds[a], kinds[b]] += drawn[:, c]
            e[:, kinds[b], kinds[a]] += drawn[:, c]
        e /= 2 * n
        expected = (e.sum(axis=2) * e.sum(axis=1)).sum(axis=1)
        good = expected < 1
        r = (np.trace(e, axis1=1, axis2=2)[good] - expected[good]) / (1 - expected[good])
        mean, se = (float(r.mean()), float(r.std())) if len(r) else (0.0, 0.0)
        return pd.DataFrame({"layer": [pdf["layer"].iloc[0]], "mean": [round(mean, 6)], "se": [round(se, 6)]})

    return cells.groupBy("layer").applyInPandas(draw, "layer string, mean double, se double")


def normal_interval(mean: Column, se: Column) -> tuple[Column, Column]:
    return F.round(mean - 1.96 * se, 6), F.round(mean + 1.96 * se, 6)


@F.pandas_udf(DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    """Two-sided probability of a standard normal beyond z."""
    return z.map(lambda x: math.erfc(abs(x) / math.sqrt(2)))


def z_test(estimates: DataFrame, first: str, second: str) -> DataFrame:
    """One row: the difference of two layers' estimates (layer, mean, se), its z and p."""
    a = estimates.filter(F.col("layer") == first).select(F.col("mean").alias("mean_a"), F.col("se").alias("se_a"))
    b = estimates.filter(F.col("layer") == second).select(F.col("mean").alias("mean_b"), F.col("se").alias("se_b"))
    z = F.try_divide(F.col("mean_b") - F.col("mean_a"), F.sqrt(F.col("se_a") * F.col("se_a") + F.col("se_b") * F.col("se_b")))
    return a.crossJoin(F.broadcast(b)).withColumn("z", z).withColumn("p", two_sided_p("z"))
