"""Problem 4: the best representative of every group of duplicates, field by field.

One aggregation per table: for each field, the maximum of a composite struct (usable, rank parts, smallest id, value).
Maxima have partial aggregation with a state of constant size, so a group that holds a third of all rows costs no more
than any other, and nothing is ever collected per group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import fold_name, is_absent, strip_space

#: Evidence from weak to strong, and the relationships that count.
EVIDENCE = ("name_only", "mentioned_in", "own_source")
RELATIONSHIPS = ("alliance", "rivalry", "other")

_YEAR = r"(?<![0-9])(?:1[0-9]{3}|20[0-9]{2})(?![0-9])"
_DECADE = r"(?<![0-9])(?:1[0-9]{2}|20[0-9])0['’]?s"
#: 1985-95; what could be a month is none.
_SHORT_RANGE = r"(?<![0-9])(?:1[0-9]|20)[0-9]{2}\s*[-–—]\s*(?:1[3-9]|[2-9][0-9])(?![0-9]|-[0-9])"
_ENDED = r"(?i)(?U)\b(?:inactive|defunct|dissolved|disbanded|ended|ceased|extinct|former|formerly)\b|\b(?:until|till|through)\b(?!\W+(?:the\W+)?(?:present|now|today|current))"
_RUNNING = r"(?i)(?U)\b(?:since|present|ongoing|onwards?|now|today|currently?|active|still|date)\b|[0-9]s?\s*[-–—]\s*\??$|\bfrom\s+\S*[0-9]{4}s?$"


@dataclass(frozen=True)
class Field:
    """How one attribute survives: what value a row offers, whether it is usable, and by what ranks rows compare."""

    name: str
    value: Column
    usable: Column
    ranks: tuple[Column, ...] = ()


def end_year(period: Column) -> Column:
    """The last year a text states, short ranges such as 1985-95 written out; a decade ends in its last year; 9999 if open-ended; null without year or decade."""
    years = F.transform(F.regexp_extract_all(period, F.lit(_YEAR), F.lit(0)), lambda y: y.cast("int"))
    decades = F.transform(F.regexp_extract_all(period, F.lit(_DECADE), F.lit(0)), lambda d: F.substring(d, 1, 4).cast("int") + 9)
    spans = F.transform(F.regexp_extract_all(period, F.lit(_SHORT_RANGE), F.lit(0)), lambda m: F.concat(F.substring(m, 1, 2), F.right(m, F.lit(2))).cast("int"))
    last = F.array_max(F.concat(years, decades, spans))
    trimmed = strip_space(period)
    return F.when(last.isNotNull() & trimmed.rlike(_RUNNING) & ~trimmed.rlike(_ENDED), F.lit(9999)).otherwise(last)


def survive(df: DataFrame, keys: list[str], id_col: str, fields: list[Field]) -> DataFrame:
    """One row per group: keys, group_id (the smallest id), n_rows, and for each field NAME and NAME_id.

    NAME_id is the id of the row that supplies the field, the smallest on a tie, 0 where no row is usable; NAME is then
    null. Ranks compare from the first on, nulls lowest. Rows with a null id are left out. Repeated rows count as rows
    but change no value. An empty table gives no row. Columns of df that are not used are dropped, so names of other
    columns cannot clash.
    """
    best = [
        F.max(F.when(F.coalesce(f.usable, F.lit(False)), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(f.ranks)], (-F.col("_id")).alias("back"), f.value.alias("value")))).alias(f"_{f.name}")
        for f in fields
    ]
    rows = df.withColumn("_id", F.col(id_col)).filter("_id is not null")
    grouped = rows.groupBy(*keys).agg(F.min("_id").alias("group_id"), F.count(F.lit(1)).alias("n_rows"), *best)
    out = [c for f in fields for c in (F.col(f"_{f.name}.value").alias(f.name), F.coalesce(-F.col(f"_{f.name}.back"), F.lit(0)).alias(f"{f.name}_id"))]
    return grouped.select(*keys, "group_id", "n_rows", *out)


def edge_survivors(edges: DataFrame) -> DataFrame:
    """One record per unordered pair of different, non-blank folded names of an edge table.

    time_period comes from the row whose period ends latest, context is the longest after trimming, relationship has the
    strongest evidence, then the latest merged_at.
    """
    source, target = fold_name(F.col("source")), fold_name(F.col("target"))
    rows = edges.select(
        F.least(source, target).alias("name_a"), F.greatest(source, target).alias("name_b"),
        "edge_id", "time_period", "context", "relationship", "evidence", "merged_at",
    ).filter((source != "") & (target != "") & (source != target))
    context, relationship = strip_space(F.col("context")), F.lower(strip_space(F.col("relationship")))
    strength = F.coalesce(F.array_position(F.array(*map(F.lit, EVIDENCE)), F.lower(F.trim("evidence"))), F.lit(0))
    fields = [
        Field("time_period", F.col("time_period"), end_year(F.col("time_period")).isNotNull(), (end_year(F.col("time_period")),)),
        Field("context", context, ~is_absent(F.col("context")), (F.length(context),)),
        Field("relationship", relationship, relationship.isin(*RELATIONSHIPS), (strength, F.col("merged_at"))),
    ]
    return survive(rows, ["name_a", "name_b"], "edge_id", fields)


def survivors_found(records: DataFrame) -> DataFrame:
    """The pairs with two or more edges, as ids."""
    return records.filter("n_rows > 1").select(
        "group_id", F.col("time_period_id").alias("time_period_edge_id"), F.col("context_id").alias("context_edge_id"), F.col("relationship_id").alias("relationship_edge_id")
    )
