"""Queries of entity resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import is_absent
from ..functions.urls import valid_urls
from ..operators import entities as E
from .common import DOMAIN, Registry, absent, alias_variants, fold, joined, longest, node_type, table, text_set

_r = Registry()

#: Prefixes that make an umbrella name together with a generic ending; a parameter of the rule.
PREFIXES = ("the", "la", "il", "los", "die")
KEEP, BLOCK = ("the mob",), ("the family", "la familia", "the outfit")


def _order() -> Column:
    return F.struct("source_file", "node_no", "mention_id")


_ORDER = "source_file, node_no, mention_id"
#: As in the engine, the delivery loaded last stands for a mention.
_LATEST = "x AS (SELECT * FROM extracted QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY loaded_at DESC) = 1)"


def mentions(spark: SparkSession, d: str) -> DataFrame:
    return E.latest_delivery(table(spark, d, "extracted"), "mention_id", "loaded_at")


@_r.query("SELECT mention_id, max(loaded_at) AS loaded_at FROM extracted GROUP BY 1")
def latest_delivery(spark: SparkSession, d: str) -> DataFrame:
    return mentions(spark, d).select("mention_id", "loaded_at")


def _merged(spark: SparkSession, d: str) -> DataFrame:
    articles = table(spark, d, "articles").groupBy("folder_name").agg(F.max_by("url", F.struct("fetched_at", "url")).alias("url"))
    rows = mentions(spark, d).join(articles.withColumnRenamed("folder_name", "source_file"), "source_file", "left")
    return E.merge_mentions(rows, _order(), "url")


@_r.query(f"""
WITH {_LATEST}, ar AS (SELECT folder_name, first(url ORDER BY fetched_at DESC, url DESC) AS url FROM articles GROUP BY 1),
k AS (SELECT x.*, {fold('standard_name')} AS name_key, url FROM x LEFT JOIN ar ON folder_name = source_file WHERE {fold('standard_name')} <> ''),
al AS (SELECT name_key, {text_set('a')} AS aliases FROM (SELECT name_key, unnest(aliases) AS a FROM k) GROUP BY 1)
SELECT name_key, first(strip(standard_name) ORDER BY {_ORDER}) AS standard_name, {text_set('original_text_name')} AS original_text_names, coalesce(max(al.aliases), '') AS aliases,
  coalesce(nullif(first(type ORDER BY {_ORDER}), ''), 'criminal_organization') AS type, {longest('context', _ORDER)} AS context, nullif({longest('time_period', _ORDER)}, '') AS time_period,
  {text_set('source_file')} AS source_articles, {text_set('url')} AS wikipedia_urls
FROM k LEFT JOIN al USING (name_key) GROUP BY name_key""")
def entity_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = _merged(spark, d)
    return rows.withColumns({c: joined(c) for c in ("original_text_names", "aliases", "source_articles", "wikipedia_urls")})


@_r.query(f"""
WITH {_LATEST}, k AS (SELECT *, lower(strip(standard_name)) AS name_key FROM x WHERE strip(standard_name) <> ''),
al AS (SELECT source_file, name_key, {text_set('a')} AS aliases FROM (SELECT source_file, name_key, unnest(aliases) AS a FROM k) GROUP BY 1, 2)
SELECT source_file, name_key, first(standard_name ORDER BY {_ORDER}) AS standard_name, first(type ORDER BY {_ORDER}) AS type, first(context ORDER BY {_ORDER}) AS context,
  coalesce(max(al.aliases), '') AS aliases, count(*) AS n_records
FROM k LEFT JOIN al USING (source_file, name_key) GROUP BY 1, 2""")
def chunk_node_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = E.merge_chunk_nodes(mentions(spark, d), "source_file", _order())
    return rows.select("source_file", "name_key", "standard_name", "type", "context", joined("aliases").alias("aliases"), "n_records")


@_r.query(f"SELECT name_key, array_to_string(list_sort(list(DISTINCT a)), '|') AS aliases FROM (SELECT {fold('standard_name')} AS name_key, unnest(aliases) AS raw, trim(regexp_replace(raw, '[\\s\\x{{A0}}]+', ' ', 'g')) AS a FROM global_network_nodes) WHERE name_key <> '' AND NOT {absent('raw')} GROUP BY 1")
def alias_union(spark: SparkSession, d: str) -> DataFrame:
    return E.unite_aliases(table(spark, d, "global_network_nodes")).select("name_key", joined("aliases").alias("aliases"))


@_r.query(f"SELECT node_id, {node_type('type')} AS type FROM global_network_nodes")
def type_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "global_network_nodes").select("node_id", E.normalize_type(F.col("type")).alias("type"))


@_r.query("SELECT node_id, standard_name FROM global_network_nodes WHERE coalesce(lower(strip(standard_name)) NOT IN (SELECT lower(strip(name)) FROM generic_names), true)")
def exclusion_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return E.exclude(table(spark, d, "global_network_nodes"), table(spark, d, "generic_names")).select("node_id", "standard_name")


_LISTED = ", ".join(f"'{t}'" for t in E.NODE_TYPES)


@_r.query(f"""
WITH {_LATEST}, o AS (SELECT lower(strip(standard_name)) AS n, first(type ORDER BY mention_id DESC) AS t FROM x WHERE type IN ({_LISTED}) AND standard_name IS NOT NULL GROUP BY 1)
SELECT node_id, standard_name, coalesce(t, type) AS type FROM global_network_nodes LEFT JOIN o ON lower(strip(standard_name)) = n""")
def override_left_join(spark: SparkSession, d: str) -> DataFrame:
    overrides = mentions(spark, d).filter(F.col("type").isin(*E.NODE_TYPES) & F.col("standard_name").isNotNull()).select(F.col("mention_id").alias("entry"), F.col("standard_name").alias("name"), "type")
    return E.override_types(table(spark, d, "global_network_nodes"), overrides).select("node_id", "standard_name", "type")


def _generic_sql(c: str) -> str:
    n = f"lower(strip({c}))"
    lists = {k: "(" + ", ".join(f"'{x}'" for x in v) + ")" for k, v in (("p", PREFIXES), ("k", KEEP), ("b", BLOCK))}
    rules = " OR ".join(f"(regexp_matches({n}, '{e}') AND strip(regexp_replace({n}, '{e}', '', 'g')) IN {lists['p']})" for e in E.GENERIC_ENDINGS)
    return f"CASE WHEN {n} IN {lists['k']} THEN false WHEN {n} IN {lists['b']} THEN true ELSE ({rules}) END"


@_r.query(f"SELECT DISTINCT a AS name, {_generic_sql('a')} AS generic FROM (SELECT unnest(aliases) AS a FROM global_network_nodes UNION ALL SELECT standard_name FROM global_network_nodes) WHERE a IS NOT NULL")
def generic_name_filter(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "global_network_nodes")
    names = n.select(F.explode("aliases").alias("name")).union(n.select("standard_name")).filter("name is not null").distinct()
    return names.select("name", E.is_generic(F.col("name"), PREFIXES, KEEP, BLOCK).alias("generic"))


_VARIANTS = f"""
va AS (SELECT node_id AS entry, standard_name AS canonical, unnest(coalesce(aliases, [])) AS variant, 0 AS own FROM global_network_nodes WHERE strip(standard_name) <> ''),
vf AS (SELECT * FROM va WHERE NOT {absent('variant')}),
vb AS (SELECT * FROM vf UNION ALL SELECT entry, canonical, canonical, 1 FROM vf),
vc AS (SELECT lower(strip(variant)) AS variant, first(canonical ORDER BY entry DESC, own DESC) AS canonical FROM vb GROUP BY 1)"""


@_r.query(f"""
WITH {_VARIANTS.strip()},
n AS (SELECT g.*, coalesce(canonical, standard_name) AS c, {fold('coalesce(canonical, standard_name)')} AS name_key FROM global_network_nodes g LEFT JOIN vc ON lower(strip(standard_name)) = variant),
al AS (SELECT name_key, {text_set('a')} AS aliases FROM (SELECT name_key, unnest(list_concat(coalesce(aliases, []), CASE WHEN c <> standard_name THEN [standard_name] ELSE [] END)) AS a FROM n) GROUP BY 1),
ar AS (SELECT name_key, {text_set('a')} AS source_articles FROM (SELECT name_key, unnest(source_articles) AS a FROM n) GROUP BY 1)
SELECT name_key, first(c ORDER BY node_id) AS standard_name, first(type ORDER BY node_id) AS type, coalesce(max(al.aliases), '') AS aliases, coalesce(max(ar.source_articles), '') AS source_articles,
  {longest('context', 'node_id')} AS context, nullif({longest('time_period', 'node_id')}, '') AS time_period
FROM n LEFT JOIN al USING (name_key) LEFT JOIN ar USING (name_key) GROUP BY name_key""")
def canonical_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = E.apply_canonical(table(spark, d, "global_network_nodes"), alias_variants(spark, d), F.col("node_id"))
    return rows.select("name_key", "standard_name", "type", joined("aliases").alias("aliases"), joined("source_articles").alias("source_articles"), "context", "time_period")


@_r.query(f"WITH {_VARIANTS.strip()} SELECT canonical, count(DISTINCT standard_name) AS n, {text_set('standard_name')} AS names FROM global_network_nodes JOIN vc ON lower(strip(standard_name)) = variant WHERE standard_name <> canonical GROUP BY 1")
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return E.duplicate_groups(table(spark, d, "global_network_nodes"), alias_variants(spark, d)).withColumn("names", joined("names"))


_OWN = r"""
u AS (SELECT node_id, lower(strip(standard_name)) AS n, list_transform(coalesce(aliases, []), lambda a: lower(strip(a))) AS al,
  unnest(wikipedia_urls) AS url, generate_subscripts(wikipedia_urls, 1) AS i FROM global_network_nodes),
v AS (SELECT *, replace(CASE WHEN regexp_matches(url, 'title=[^&]') THEN url_decode(replace(regexp_extract(url, 'title=([^&]+)', 1), '+', '%2B'))
  WHEN url LIKE '%/wiki/%' THEN url_decode(replace(regexp_extract(url, '.*/wiki/([^?#]*)', 1), '+', '%2B')) END, '_', ' ') AS title FROM u WHERE url IS NOT NULL),
w AS (SELECT *, lower(strip(title)) AS t FROM v),
o AS (SELECT node_id, min(i) AS i FROM w WHERE t = n OR list_contains(al, t) OR (contains(t, n) AND length(n) > length(t) * 0.5) GROUP BY 1),
s AS (SELECT node_id, max(CASE WHEN w.i = o.i THEN url END) AS own_url, max(CASE WHEN w.i = o.i THEN title END) AS own_title, count(*) FILTER (WHERE o.i IS NULL OR w.i <> o.i) AS n_mentions FROM w LEFT JOIN o USING (node_id) GROUP BY 1)"""


@_r.query(f"WITH {_OWN.strip()} SELECT g.node_id, own_url, own_title, coalesce(n_mentions, 0) AS n_mentions FROM global_network_nodes g LEFT JOIN s USING (node_id)")
def own_source_split(spark: SparkSession, d: str) -> DataFrame:
    rows = E.split_sources(table(spark, d, "global_network_nodes"))
    return rows.select("node_id", F.col("own_source.url").alias("own_url"), F.col("own_source.title").alias("own_title"), F.size("mentioned_in").cast("bigint").alias("n_mentions"))


FINAL_SQL = f"""fin AS (SELECT *, {node_type('type')} AS ntype FROM global_network_nodes WHERE {node_type('type')} IN ({_LISTED})
  AND NOT ({_generic_sql('standard_name')}) AND lower(strip(standard_name)) NOT IN (SELECT lower(strip(name)) FROM generic_names))"""


def final_nodes(spark: SparkSession, d: str) -> DataFrame:
    n = E.clean_nodes(table(spark, d, "global_network_nodes"), table(spark, d, "generic_names"), DOMAIN)
    return n.filter(F.col("type").isin(*E.NODE_TYPES) & ~E.is_generic(F.col("standard_name"), PREFIXES, KEEP, BLOCK))


@_r.query(f"""
WITH {FINAL_SQL}, {_OWN.strip()}
SELECT standard_name AS name, ntype AS type, coalesce(context, '') AS descriptions, CASE WHEN {absent('time_period')} THEN NULL ELSE time_period END AS time_period, own_title, coalesce(n_mentions, 0) AS n_mentions
FROM fin LEFT JOIN s USING (node_id)""".replace("WHERE url IS NOT NULL", f"WHERE url LIKE '%{DOMAIN}/%'"))
def final_entities(spark: SparkSession, d: str) -> DataFrame:
    n = E.clean_nodes(table(spark, d, "global_network_nodes"), table(spark, d, "generic_names"), DOMAIN)
    rows = E.final_entities(n, PREFIXES, KEEP, BLOCK)
    return rows.select("name", "type", joined("descriptions").alias("descriptions"), "time_period", F.col("own_source.title").alias("own_title"), F.size("mentioned_in").cast("bigint").alias("n_mentions"))


QUERIES, SQL = _r.queries, _r.sql
