"""Entity resolution: merging mentions into nodes, curated look-ups, filters, and source attribution.

Merges keep what the first record says (spelling, type) and the longest texts. Spark has no order of its own, so callers name
the columns that give it; ties are then decided, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import fold_name, is_absent, squeeze, strip_space
from ..functions.urls import source_title, valid_urls
from .joins import shuffled

#: Node types of the vocabulary, and other wordings that models fall back to.
NODE_TYPES = ("cartel", "mafia", "gang", "motorcycle_club", "faction", "clan", "triad", "militia", "terrorist_organization")
TYPE_FALLBACK = {
    "crime_family": "mafia",
    "crime_syndicate": "mafia",
    "criminal_organization": "other",
    "organized_crime_group": "other",
    "crew": "gang",
    "yakuza": "mafia",
    "secret_society": "other",
}
#: Endings of names that stand for a whole trade of a nation.
GENERIC_ENDINGS = (
    r"\bmafia$", r"\borganized crime$", r"\borganised crime$", r"\bcrime groups?$", r"\bcriminal organizations?$", r"\bcriminal groups?$",
    r"\bdrug cartels?$", r"\bgangs?$", r"\bcriminal networks?$", r"\bcrime syndicate$", r"\bunderworld$", r"\bcriminal underworld$", r"\bmob$",
)
#: Small look-ups of up to so many rows go to every task; larger ones join by shuffle.
BROADCAST_ROWS = 500_000

_STRINGS = "array<string>"


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint, if the frame is counted small enough for it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def strings(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(_STRINGS))


def longest(c: Column, order: Column) -> Column:
    """The longest value of a group, the first of equally long ones; blank values never win over text."""
    return F.min_by(c, F.struct(-F.length(c), order))


def with_sets(grouped: DataFrame, rows: DataFrame, keys: list[str], sets: dict[str, Column]) -> DataFrame:
    """Grouped rows with sorted sets of all strings in arrays of `rows`, without null and empty ones, empty where a group has none.

    The arrays are taken apart and their members made distinct before anything is collected, so no state of a group is larger than its result,
    however many rows it has.
    """

    def tagged(k: int, c: Column) -> Column:
        return F.transform(strings(c), lambda x: F.struct(F.lit(k).alias("set"), x.alias("x")))

    members = rows.select(*keys, F.explode(F.array_distinct(F.concat(*[tagged(k, c) for k, c in enumerate(sets.values())]))).alias("_m")).select(*keys, "_m.set", "_m.x").filter("x <> ''").distinct()
    own = members.groupBy(*keys).agg(*[F.array_sort(F.collect_set(F.when(F.col("set") == k, F.col("x")))).alias(name) for k, name in enumerate(sets)])
    return grouped.join(shuffled(own), keys, "left").withColumns({name: strings(F.col(name)) for name in sets})


def text_set(c: Column) -> Column:
    return F.array_sort(F.collect_set(F.when(c != "", c)))


def latest_delivery(df: DataFrame, key: str, loaded: str) -> DataFrame:
    """One row per key, the one loaded last; rows are carried whole through one aggregation."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key).agg(F.max_by(row, F.struct(loaded, F.xxhash64(*[c for c in df.columns if c not in (key, loaded)]))).alias("r")).select("r.*")


def merge_mentions(mentions: DataFrame, order: Column, url: str | None = None) -> DataFrame:
    """Nodes from mentions, one per name compared without case and spacing.

    First spelling and type, sets of original names, aliases, articles and addresses, longest context and period. Blank
    names are dropped; a missing type is `criminal_organization`.
    """
    rows = mentions.withColumn("name_key", fold_name(F.col("standard_name"))).filter("name_key <> ''").withColumn("_o", order)
    merged = rows.groupBy("name_key").agg(
        F.min_by(strip_space("standard_name"), "_o").alias("standard_name"),
        F.coalesce(F.nullif(F.min_by("type", "_o"), F.lit("")), F.lit("criminal_organization")).alias("type"),
        longest(F.coalesce("context", F.lit("")), F.col("_o")).alias("context"),
        F.nullif(longest(F.coalesce("time_period", F.lit("")), F.col("_o")), F.lit("")).alias("time_period"),
    )
    sets = {"original_text_names": F.array("original_text_name"), "aliases": F.col("aliases"), "source_articles": F.array("source_file"), "wikipedia_urls": F.array(F.col(url)) if url else F.array().cast(_STRINGS)}
    return with_sets(merged, rows, ["name_key"], sets).select("name_key", "standard_name", "original_text_names", "aliases", "type", "context", "time_period", "source_articles", "wikipedia_urls")


def merge_chunk_nodes(mentions: DataFrame, article: str, order: Column) -> DataFrame:
    """Nodes of one article from its chunks: the first record of a name, with the aliases of all."""
    rows = mentions.withColumn("name_key", F.lower(strip_space("standard_name"))).filter("name_key <> ''").withColumn("_o", order)
    first = F.struct("standard_name", "original_text_name", "type", "context", "time_period")
    merged = rows.groupBy(article, "name_key").agg(F.min_by(first, "_o").alias("n"), F.count(F.lit(1)).alias("n_records"))
    return with_sets(merged, rows, [article, "name_key"], {"aliases": F.col("aliases")}).select(article, "name_key", "n.*", "aliases", "n_records")


def null_words(c: Column) -> Column:
    """Null instead of blanks and words that stand for nothing."""
    return F.when(~is_absent(c), c)


def normalize_type(c: Column) -> Column:
    """A canonical type, through the fallbacks, else other."""
    t = F.lower(strip_space(F.coalesce(c, F.lit(""))))
    table = F.create_map(*[F.lit(x) for pair in TYPE_FALLBACK.items() for x in pair])
    return F.when(t.isin(*NODE_TYPES), t).otherwise(F.coalesce(table[t], F.lit("other")))


def exclude(nodes: DataFrame, excluded: DataFrame, name: str = "standard_name") -> DataFrame:
    """Nodes whose trimmed, lower-cased name is not on a list (column name)."""
    listed = small(excluded.select(F.lower(strip_space("name")).alias("_x")).distinct())
    return nodes.join(listed, F.lower(strip_space(name)) == F.col("_x"), "left_anti")


def canonical_names(variants: DataFrame) -> DataFrame:
    """(variant, canonical): one hop, the last entry of a variant wins; canonicals stand for themselves. variants: (entry, canonical, variant)."""
    own = variants.select("entry", "canonical", F.col("canonical").alias("variant"), F.lit(1).alias("own"))
    rows = variants.select("entry", "canonical", "variant", F.lit(0).alias("own")).unionByName(own)
    return rows.groupBy(F.lower(strip_space("variant")).alias("variant")).agg(F.max_by("canonical", F.struct("entry", "own")).alias("canonical"))


def apply_canonical(nodes: DataFrame, variants: DataFrame, order: Column) -> DataFrame:
    """Nodes renamed to canonical names and merged again: aliases take the old name, sets are united, longest texts kept."""
    names = small(canonical_names(variants))
    rows = nodes.join(names, F.lower(strip_space("standard_name")) == F.col("variant"), "left").withColumn("_c", F.coalesce("canonical", "standard_name"))
    renamed = F.col("_c") != F.col("standard_name")
    rows = rows.withColumn("_o", order).withColumn("_old", F.when(renamed, F.array("standard_name")).otherwise(F.array().cast(_STRINGS))).withColumn("name_key", fold_name(F.col("_c")))
    first = F.struct(F.col("_c").alias("standard_name"), "original_text_names", "type", "_old")
    grouped = rows.groupBy("name_key").agg(
        F.min_by(first, "_o").alias("n"), longest(F.coalesce("context", F.lit("")), F.col("_o")).alias("context"), F.nullif(longest(F.coalesce("time_period", F.lit("")), F.col("_o")), F.lit("")).alias("time_period"),
    )
    merged = with_sets(grouped, rows, ["name_key"], {"aliases": F.concat(strings(F.col("aliases")), F.col("_old")), "source_articles": F.col("source_articles"), "wikipedia_urls": F.col("wikipedia_urls")})
    return merged.select("name_key", "n.standard_name", "n.original_text_names", "aliases", "n.type", "context", "time_period", "source_articles", "wikipedia_urls")


def duplicate_groups(nodes: DataFrame, variants: DataFrame) -> DataFrame:
    """(canonical, n, names) of the canonical names that other spellings were renamed to."""
    names = small(canonical_names(variants))
    hit = nodes.join(names, F.lower(strip_space("standard_name")) == F.col("variant")).filter("standard_name <> canonical")
    return hit.groupBy("canonical").agg(F.countDistinct("standard_name").alias("n"), text_set(F.col("standard_name")).alias("names"))


def override_types(nodes: DataFrame, overrides: DataFrame) -> DataFrame:
    """Types from a list (entry, name, type), the last entry of a name winning; other nodes keep theirs."""
    table = overrides.groupBy(F.lower(strip_space("name")).alias("_n")).agg(F.max_by("type", "entry").alias("_t"))
    return nodes.join(small(table), F.lower(strip_space("standard_name")) == F.col("_n"), "left").withColumn("type", F.coalesce("_t", "type")).drop("_n", "_t")


def is_generic(name: Column, prefixes: tuple[str, ...], keep: tuple[str, ...] = (), block: tuple[str, ...] = (), endings: tuple[str, ...] = GENERIC_ENDINGS) -> Column:
    """Whether a name is an umbrella term: kept names never, blocked ones always, else a listed prefix before a generic ending."""
    n = F.lower(strip_space(name))
    left = [strip_space(F.regexp_replace(n, e, "")) for e in endings]
    rule = F.lit(False)
    for e, rest in zip(endings, left):
        rule = rule | (n.rlike(e) & rest.isin(*prefixes))
    return F.when(n.isin(*keep), False).when(n.isin(*block), True).otherwise(rule) if keep or block else rule


def split_sources(nodes: DataFrame, overrides: DataFrame | None = None, domain: str = "wikipedia.org") -> DataFrame:
    """own_source and mentioned_in, structs (url, title), from the addresses of each node.

    The first address whose title is the name, an alias, or holds the name as more than half of itself, is its own.
    Addresses without a title are only mentions. overrides (name, url, title) name the own source outright; a null url means none.
    """
    name = F.lower(strip_space("standard_name"))
    titled = F.transform(F.filter(strings(F.col("wikipedia_urls")), lambda u: u.isNotNull()), lambda u: F.struct(u.alias("url"), source_title(u).alias("title")))
    rows = nodes.withColumn("_n", name).withColumn("_a", F.transform(strings(F.col("aliases")), lambda a: F.lower(strip_space(a)))).withColumn("_u", titled)

    def own(x: Column) -> Column:
        t = F.lower(strip_space(x["title"]))
        within = F.contains(t, F.col("_n")) & (F.length("_n") > F.length(t) * 0.5)
        return F.coalesce((t == F.col("_n")) | F.coalesce(F.array_contains("_a", t), F.lit(False)) | within, F.lit(False))

    rows = rows.withColumn("_at", F.coalesce(F.array_position(F.transform("_u", own), F.lit(True)), F.lit(0)).cast("int"))
    rows = rows.withColumn("own_source", F.when(F.col("_at") > 0, F.element_at("_u", F.greatest("_at", F.lit(1)))))
    others = F.filter("_u", lambda x, i: i + 1 != F.col("_at"))
    if overrides is not None:
        table = small(overrides.select(F.lower(strip_space("name")).alias("_on"), F.struct("url", "title").alias("_os")))
        rows = rows.join(table, F.col("_n") == F.col("_on"), "left")
        rows = rows.withColumn("own_source", F.when(F.col("_on").isNotNull(), F.when(F.col("_os.url").isNotNull(), F.col("_os"))).otherwise(F.col("own_source")))
        others = F.when(F.col("_on").isNotNull(), F.filter("_u", lambda x: F.col("_os.url").isNull() | (x["url"] != F.col("_os.url")))).otherwise(others)
        rows = rows.withColumn("_m", others).drop("_on", "_os")
    else:
        rows = rows.withColumn("_m", others)
    named = F.transform("_m", lambda x: F.struct(x["url"].alias("url"), F.coalesce(F.nullif(x["title"], F.lit("")), F.lit("Wikipedia")).alias("title")))
    return rows.withColumn("mentioned_in", named).drop("_n", "_a", "_u", "_at", "_m")


def final_entities(nodes: DataFrame, prefixes: tuple[str, ...] = (), keep: tuple[str, ...] = (), block: tuple[str, ...] = (), overrides: DataFrame | None = None) -> DataFrame:
    """Published entities: canonical types only, no umbrella names, context as descriptions, sources split, aliases gone."""
    rows = nodes.filter(F.col("type").isin(*NODE_TYPES) & ~is_generic(F.col("standard_name"), prefixes, keep, block))
    rows = split_sources(rows, overrides)
    return rows.select(
        F.col("standard_name").alias("name"), "type", F.when(F.coalesce(F.col("context"), F.lit("")) != "", F.array("context")).otherwise(F.array().cast(_STRINGS)).alias("descriptions"),
        F.nullif("time_period", F.lit("")).alias("time_period"), "own_source", "mentioned_in",
    )


def clean_nodes(nodes: DataFrame, excluded: DataFrame, domain: str = "wikipedia.org") -> DataFrame:
    """Types normalized, listed names removed, periods without meaning nulled, addresses checked."""
    rows = nodes.withColumn("type", normalize_type(F.col("type"))).withColumn("time_period", null_words(F.col("time_period"))).withColumn("wikipedia_urls", valid_urls(F.col("wikipedia_urls"), domain))
    return exclude(rows, excluded)


def unite_aliases(nodes: DataFrame) -> DataFrame:
    """(name_key, aliases): the squeezed aliases of all nodes of a name, sorted, without absent values."""
    rows = nodes.select(fold_name(F.col("standard_name")).alias("name_key"), F.explode(strings(F.col("aliases"))).alias("a")).filter((F.col("name_key") != "") & ~is_absent(F.col("a")))
    return rows.groupBy("name_key").agg(F.array_sort(F.collect_set(squeeze(F.col("a")))).alias("aliases"))
