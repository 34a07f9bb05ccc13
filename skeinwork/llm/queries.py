"""The queries of this subpackage, each over its whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import canonical, grouping, leakage, mixing, resolution, spans, splitting, survivors

#: Rank file of a public tokenizer, where the session names none in spark.skeinwork.vocabulary.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(_table(spark, d, "article_content"), "content_id", "content")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized_found(p1_pieces(spark, d), "content_id")


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return grouping.node_groups(*(_table(spark, d, t) for t in ("global_network_nodes", "name_matches", "generic_names")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return grouping.groups_found(p2_groups(spark, d))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return survivors.edge_survivors(_table(spark, d, "global_network_edges"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors_found(p4_records(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_pieces, p1_found, p2_groups, p2_found, p4_records, p4_found)
}


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.SharedSpans(_table(spark, d, "documents")).pairs()


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return spans.SharedSpans(_table(spark, d, "documents")).shares()


QUERIES |= {f.__name__: f for f in (p8_found, p8_shares)}


def _mixture(spark: SparkSession, d: str) -> mixing.Mixture:
    vocabulary = spark.conf.get("spark.skeinwork.vocabulary", VOCABULARY)
    return mixing.Mixture(_table(spark, d, "documents"), _table(spark, d, "source_targets"), vocabulary)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).unreachable()


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).report()


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).sample()


QUERIES |= {f.__name__: f for f in (p7_found, p7_shares, p7_mixture)}


def p6_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.exact_leaks(_table(spark, d, "documents"), _table(spark, d, "eval_items"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_leaks(spark, d).select("doc_id", "item_id")


def p6_paraphrases(spark: SparkSession, d: str) -> DataFrame:
    return leakage.paraphrases(_table(spark, d, "documents"), _table(spark, d, "eval_items"))


QUERIES |= {f.__name__: f for f in (p6_found, p6_leaks, p6_paraphrases)}


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return resolution.resolve(_table(spark, d, "extracted"), _table(spark, d, "generic_names"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return resolution.linked_pairs(p5_groups(spark, d))


QUERIES |= {f.__name__: f for f in (p5_found, p5_groups)}


def p3_mapping(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_values(_table(spark, d, "extracted"), _table(spark, d, "type_list"), noise=canonical.NOISE, foreign=canonical.FOREIGN)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    mapping = Scratch(spark, "types").save(p3_mapping(spark, d))
    return canonical.attach(_table(spark, d, "extracted"), mapping, "mention_id", "type", "loaded_at")


QUERIES |= {f.__name__: f for f in (p3_found, p3_mapping)}
