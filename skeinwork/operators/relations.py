"""Relations: merging edges, retargeting them to canonical names, and one edge per pair by time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import fold_name, strip_space
from ..functions.periods import end_year
from ..functions.urls import source_title, valid_urls
from .entities import canonical_names, longest, null_words, small, with_sets

#: Relationships that count, and what the published layers are called.
RELATIONSHIPS = ("alliance", "rivalry", "other")
LAYERS = {"alliance": "allied_with", "rivalry": "rivals_with"}


def enforce_relationship(c: Column) -> Column:
    r = F.lower(strip_space(c))
    return F.when(r.isin(*RELATIONSHIPS), r).otherwise("other")


def merge_edges(edges: DataFrame, order: Column, lower_detail: bool = True) -> DataFrame:
    """Edges of one direction, relationship and detail as one: first spelling, longest context and period, set of addresses.

    Edges without source, target or relationship are dropped. Detail is compared in lower case, unless told otherwise as
    after canonical renaming.
    """
    detail = F.coalesce(strip_space("detail"), F.lit(""))
    rows = edges.select(
        fold_name(F.col("source")).alias("source_key"), fold_name(F.col("target")).alias("target_key"), F.lower(strip_space("relationship")).alias("relationship"),
        (F.lower(detail) if lower_detail else detail).alias("detail_key"), "source", "target", "detail", "context", "time_period", "wikipedia_urls", order.alias("_o"),
    ).filter("source_key <> '' and target_key <> '' and relationship <> ''")
    first = F.struct(strip_space("source").alias("source"), strip_space("target").alias("target"), F.nullif("detail", F.lit("")).alias("detail"))
    merged = rows.groupBy("source_key", "target_key", "relationship", "detail_key").agg(
        F.min_by(first, "_o").alias("f"), longest(F.coalesce("context", F.lit("")), F.col("_o")).alias("context"),
        F.nullif(longest(F.coalesce("time_period", F.lit("")), F.col("_o")), F.lit("")).alias("time_period"),
        F.count(F.lit(1)).alias("n_edges"),
    )
    merged = with_sets(merged, rows, ["source_key", "target_key", "relationship", "detail_key"], {"wikipedia_urls": F.col("wikipedia_urls")})
    return merged.select("source_key", "target_key", "f.source", "f.target", "relationship", "f.detail", "detail_key", "context", "time_period", "wikipedia_urls", "n_edges")


def distinct_edges(edges: DataFrame, order: Column) -> DataFrame:
    """The first edge of each (source, target, relationship, detail), compared trimmed and without case; incomplete ones dropped."""
    key = [F.lower(strip_space(F.coalesce(c, F.lit("")))).alias(f"_{c}") for c in ("source", "target", "relationship", "detail")]
    row = F.struct(*[F.col(c) for c in edges.columns])
    rows = edges.select(*key, row.alias("_r"), order.alias("_o")).filter("_source <> '' and _target <> '' and _relationship <> ''")
    return rows.groupBy("_source", "_target", "_relationship", "_detail").agg(F.min_by("_r", "_o").alias("r")).select("r.*")


def retarget(edges: DataFrame, variants: DataFrame) -> DataFrame:
    """Edge ends renamed to canonical names, self-loops by folded name dropped."""
    names = small(canonical_names(variants))
    a, b = names.toDF("_va", "_ca"), names.toDF("_vb", "_cb")
    rows = edges.join(a, F.lower(strip_space("source")) == F.col("_va"), "left").join(b, F.lower(strip_space("target")) == F.col("_vb"), "left")
    rows = rows.withColumn("source", F.coalesce("_ca", "source")).withColumn("target", F.coalesce("_cb", "target")).drop("_va", "_ca", "_vb", "_cb")
    return without_loops(rows)


def without_loops(edges: DataFrame) -> DataFrame:
    return edges.filter(fold_name(F.col("source")) != fold_name(F.col("target")))


def between(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges whose ends are both among the names (column name), by exact spelling."""
    known = names.select("name").distinct()
    return edges.join(known, F.col("source") == F.col("name"), "left_semi").join(known, F.col("target") == F.col("name"), "left_semi")


def clean_edges(edges: DataFrame, domain: str = "wikipedia.org") -> DataFrame:
    """Relationships enforced, periods and details without meaning nulled, addresses checked."""
    return edges.withColumns({
        "relationship": enforce_relationship(F.col("relationship")), "detail": null_words(F.col("detail")),
        "time_period": null_words(F.col("time_period")), "wikipedia_urls": valid_urls(F.col("wikipedia_urls"), domain),
    })


def final_relations(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Published relations: layers only, both ends entities, context as descriptions, addresses with titles."""
    table = F.create_map(*[F.lit(x) for pair in LAYERS.items() for x in pair])
    kept = between(edges.filter(F.col("relationship").isin(*LAYERS)), entities)
    empty = F.array().cast("array<string>")
    return kept.select(
        "source", "target", table[F.col("relationship")].alias("type"), F.when(F.coalesce(F.col("context"), F.lit("")) != "", F.array("context")).otherwise(empty).alias("descriptions"),
        F.nullif("time_period", F.lit("")).alias("time_period"), F.transform(F.coalesce("wikipedia_urls", empty), lambda u: F.struct(u.alias("url"), F.coalesce(source_title(u), F.lit("Wikipedia")).alias("title"))).alias("sources"),
    )


def first_candidate(groups: DataFrame) -> DataFrame:
    """The chooser used where a model cannot be asked: the first candidate. groups: (pair columns, candidates)."""
    return groups.select(*[c for c in groups.columns if c != "candidates"], F.lit(0).alias("choice"))


def one_per_pair(edges: DataFrame, order: Column, as_of_year: int, chooser: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One edge per unordered pair, and what the others add.

    Where all edges of a pair have an end year, the latest survives, the first on a tie; else the chooser decides, of
    whose candidates the first survives by default. Columns: a, b, the survivor's columns, n_edges, resolved (single, date or
    chooser), dates. The default needs no list of candidates, so it is one aggregation with constant state per
    pair; a chooser gets the candidates of the undecided pairs only.
    """
    row = F.struct(*[F.col(c) for c in edges.columns])
    rows = edges.select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b"), row.alias("r"), order.alias("o"), end_year(F.col("time_period"), as_of_year).alias("year"))
    best = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_edges"), F.count("year").alias("dates"), F.min_by("r", F.struct(-F.col("year"), "o")).alias("latest"), F.min_by("r", "o").alias("first"))
    dated = F.col("n_edges") == F.col("dates")
    how = F.when(F.col("n_edges") == 1, "single").when(dated, "date").otherwise("chooser")
    decided = best.select("a", "b", "n_edges", "dates", how.alias("resolved"), F.when(dated, F.col("latest")).otherwise(F.col("first")).alias("r"))
    if chooser is not None:
        asked = decided.filter("resolved = 'chooser'").select("a", "b")
        listed = rows.join(asked, ["a", "b"]).groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("o", "r"))).alias("candidates"))  # the candidates of one question
        chosen = chooser(listed).join(listed, ["a", "b"]).select("a", "b", F.get("candidates", F.when(F.col("choice").between(0, F.size("candidates") - 1), F.col("choice")).otherwise(0))["r"].alias("_r"))
        decided = decided.join(chosen, ["a", "b"], "left").withColumn("r", F.coalesce("_r", "r")).drop("_r")
    return decided.select("a", "b", "r.*", "n_edges", "dates", "resolved")


def fold_provenance(survivors: DataFrame, edges: DataFrame, order: Column) -> DataFrame:
    """(a, b, descriptions, urls): the survivor's first, then what other edges of the pair add, in order, without repeats.

    The distinct texts and addresses of a pair are aggregated with their first place, so repeated edges cost nothing.
    """
    pair = [F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")]
    kept = survivors.select("a", "b", F.col("edge_id").alias("_kept"))
    rows = edges.select(*pair, order.alias("o"), "edge_id", "context", "wikipedia_urls").join(kept, ["a", "b"]).withColumn("o", F.struct((F.col("edge_id") != F.col("_kept")).alias("later"), F.col("o").alias("o")))
    texts = rows.filter("context <> ''").groupBy("a", "b", F.col("context").alias("x")).agg(F.min("o").alias("o"))
    links = rows.select("a", "b", "o", F.posexplode("wikipedia_urls").alias("i", "x")).filter("x <> ''").groupBy("a", "b", "x").agg(F.min(F.struct("o", "i")).alias("o"))

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("a", "b").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "x"))), lambda s: s["x"]).alias(name))

    return kept.drop("_kept").join(listed(texts, "descriptions"), ["a", "b"], "left").join(listed(links, "urls"), ["a", "b"], "left")


def resolution_counts(pairs: DataFrame) -> DataFrame:
    """How many pairs were single, decided by date and by the chooser, and how many edges were dropped."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("resolved") == "single").alias("n_single"), F.count_if(F.col("resolved") == "date").alias("n_by_date"),
        F.count_if(F.col("resolved") == "chooser").alias("n_by_chooser"), F.coalesce(F.sum(F.col("n_edges") - 1), F.lit(0)).alias("n_dropped"),
    )
