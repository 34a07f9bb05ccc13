"""Queries of relation merging and per-pair resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import end_year
from ..operators import entities as E
from ..operators import relations as R
from .common import ABSENT, AS_OF, DOMAIN, Registry, absent, alias_variants, fold, joined, longest, rel, table, text_set

_r = Registry()
_YEARS = "regexp_extract_all(lower(strip(time_period)), '\\b(1[7-9][0-9]{2}|20[0-9]{2})\\b', 1)"
_YEAR = f"""CASE WHEN time_period IS NULL OR lower(strip(time_period)) IN {ABSENT} THEN NULL
WHEN regexp_matches(lower(strip(time_period)), 'present|today|current|currently|now|ongoing|active|still active') THEN {AS_OF}
ELSE list_max(list_transform({_YEARS}, lambda y: CAST(y AS INTEGER))) END"""
_URLS = f"list_filter(coalesce(wikipedia_urls, []), lambda u: u LIKE '%{DOMAIN}/%')"


def _merge_sql(source: str, detail: str) -> str:
    return f"""
WITH r AS (SELECT {fold('source')} AS source_key, {fold('target')} AS target_key, lower(strip(relationship)) AS relationship, {detail} AS detail_key,
  strip(source) AS source, strip(target) AS target, nullif(detail, '') AS detail, context, time_period, wikipedia_urls, edge_id FROM {source}),
k AS (SELECT * FROM r WHERE source_key <> '' AND target_key <> '' AND relationship <> ''),
u AS (SELECT source_key, target_key, relationship, detail_key, {text_set('u')} AS urls FROM (SELECT *, unnest(wikipedia_urls) AS u FROM k) GROUP BY ALL)
SELECT source_key, target_key, relationship, detail_key, first(source ORDER BY edge_id) AS source, first(target ORDER BY edge_id) AS target,
  first(detail ORDER BY edge_id) AS detail, {longest('context', 'edge_id')} AS context, nullif({longest('time_period', 'edge_id')}, '') AS time_period,
  coalesce(max(urls), '') AS wikipedia_urls, count(*) AS n_edges
FROM k LEFT JOIN u USING (source_key, target_key, relationship, detail_key) GROUP BY 1, 2, 3, 4
"""


_DETAIL = "coalesce(strip(detail), '')"
_LOWER_DETAIL = f"lower({_DETAIL})"


@_r.query(_merge_sql("global_network_edges", _LOWER_DETAIL))
def edge_merge(spark: SparkSession, d: str) -> DataFrame:
    merged = R.merge_edges(table(spark, d, "global_network_edges"), F.col("edge_id"))
    return merged.withColumn("wikipedia_urls", joined("wikipedia_urls"))


_CANONICAL = f"""
va AS (SELECT node_id AS entry, standard_name AS canonical, unnest(coalesce(aliases, [])) AS variant, 0 AS own FROM global_network_nodes WHERE strip(standard_name) <> ''),
vf AS (SELECT * FROM va WHERE NOT {absent('variant')}),
vb AS (SELECT * FROM vf UNION ALL SELECT entry, canonical, canonical, 1 FROM vf),
vc AS (SELECT lower(strip(variant)) AS variant, first(canonical ORDER BY entry DESC, own DESC) AS canonical FROM vb GROUP BY 1)"""
_RETARGETED = f"""
rt AS (SELECT edge_id, coalesce(x.canonical, source) AS source, coalesce(y.canonical, target) AS target, relationship, detail, context, time_period, wikipedia_urls
  FROM global_network_edges LEFT JOIN vc x ON lower(strip(source)) = x.variant LEFT JOIN vc y ON lower(strip(target)) = y.variant),
rl AS (SELECT * FROM rt WHERE {fold('source')} <> {fold('target')})"""


@_r.query(f"WITH {_CANONICAL.strip()}, {_RETARGETED.strip()}, {_merge_sql('rl', _DETAIL).strip()[5:]}")
def edge_retarget(spark: SparkSession, d: str) -> DataFrame:
    moved = R.retarget(table(spark, d, "global_network_edges"), alias_variants(spark, d))
    return R.merge_edges(moved, F.col("edge_id"), lower_detail=False).withColumn("wikipedia_urls", joined("wikipedia_urls"))


@_r.query(f"SELECT edge_id, source, target FROM global_network_edges WHERE {fold('source')} <> {fold('target')}")
def self_loop_filter(spark: SparkSession, d: str) -> DataFrame:
    return R.without_loops(table(spark, d, "global_network_edges")).select("edge_id", "source", "target")


@_r.query("SELECT edge_id, source, target FROM global_network_edges WHERE source IN (SELECT standard_name FROM global_network_nodes) AND target IN (SELECT standard_name FROM global_network_nodes)")
def endpoint_semi_join(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "global_network_nodes").select(F.col("standard_name").alias("name"))
    return R.between(table(spark, d, "global_network_edges"), names).select("edge_id", "source", "target")


_DIST = ", ".join(f"lower(strip(coalesce({c}, ''))) AS k{i}" for i, c in enumerate(("source", "target", "relationship", "detail")))


@_r.query(f"SELECT edge_id, source, target, relationship, detail FROM (SELECT *, row_number() OVER (PARTITION BY k0, k1, k2, k3 ORDER BY edge_id) AS n FROM (SELECT *, {_DIST} FROM global_network_edges) WHERE k0 <> '' AND k1 <> '' AND k2 <> '') WHERE n = 1")
def edge_distinct_first(spark: SparkSession, d: str) -> DataFrame:
    return R.distinct_edges(table(spark, d, "global_network_edges"), F.col("edge_id")).select("edge_id", "source", "target", "relationship", "detail")


@_r.query(f"SELECT edge_id, CASE WHEN {absent('time_period')} THEN NULL ELSE time_period END AS time_period, CASE WHEN {absent('detail')} THEN NULL ELSE detail END AS detail FROM global_network_edges")
def null_sanitize(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "global_network_edges")
    return e.select("edge_id", E.null_words(F.col("time_period")).alias("time_period"), E.null_words(F.col("detail")).alias("detail"))


@_r.query(f"SELECT edge_id, {rel('relationship')} AS relationship FROM global_network_edges")
def relationship_enforce(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "global_network_edges").select("edge_id", R.enforce_relationship(F.col("relationship")).alias("relationship"))


@_r.query(f"SELECT edge_id, time_period, CAST({_YEAR} AS INTEGER) AS end_year FROM global_network_edges")
def end_year_parse(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "global_network_edges")
    return e.select("edge_id", "time_period", end_year(F.col("time_period"), AS_OF).alias("end_year"))


_PAIRS = f"""
WITH p AS (SELECT least(source, target) AS a, greatest(source, target) AS b, *, {_YEAR} AS y FROM global_network_edges WHERE source IS NOT NULL AND target IS NOT NULL),
s AS (SELECT a, b, count(*) AS n_edges, count(y) AS dates, first(edge_id ORDER BY y DESC NULLS LAST, edge_id) AS latest, min(edge_id) AS earliest FROM p GROUP BY a, b),
k AS (SELECT a, b, n_edges, dates, CASE WHEN n_edges = 1 THEN 'single' WHEN n_edges = dates THEN 'date' ELSE 'chooser' END AS resolved,
  CASE WHEN n_edges = dates THEN latest ELSE earliest END AS edge_id FROM s)
"""


def _pairs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "global_network_edges").filter("source is not null and target is not null")
    return e, R.one_per_pair(e, F.col("edge_id"), AS_OF)


@_r.query(_PAIRS + "SELECT k.a, k.b, k.edge_id, relationship, time_period, n_edges, dates, resolved FROM k JOIN p USING (edge_id)")
def pair_dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)[1].select("a", "b", "edge_id", "relationship", "time_period", "n_edges", "dates", "resolved")


@_r.query(_PAIRS + """,
o AS (SELECT p.a, p.b, p.edge_id, context, wikipedia_urls, p.edge_id <> k.edge_id AS later FROM p JOIN k ON p.a = k.a AND p.b = k.b),
x AS (SELECT a, b, context AS x, min((later, edge_id)) AS o FROM o WHERE context <> '' GROUP BY ALL),
u0 AS (SELECT a, b, later, edge_id, unnest(wikipedia_urls) AS x, generate_subscripts(wikipedia_urls, 1) AS i FROM o),
u AS (SELECT a, b, x, min((later, edge_id, i)) AS o FROM u0 WHERE x <> '' GROUP BY ALL),
xs AS (SELECT a, b, string_agg(x, '|' ORDER BY o) AS descriptions FROM x GROUP BY ALL),
us AS (SELECT a, b, string_agg(x, '|' ORDER BY o) AS urls FROM u GROUP BY ALL)
SELECT a, b, coalesce(descriptions, '') AS descriptions, coalesce(urls, '') AS urls FROM k LEFT JOIN xs USING (a, b) LEFT JOIN us USING (a, b)""")
def pair_provenance_fold(spark: SparkSession, d: str) -> DataFrame:
    e, kept = _pairs(spark, d)
    rows = R.fold_provenance(kept, e, F.col("edge_id"))
    return rows.select("a", "b", F.coalesce(joined("descriptions"), F.lit("")).alias("descriptions"), F.coalesce(joined("urls"), F.lit("")).alias("urls"))


@_r.query(_PAIRS + "SELECT count(*) AS n_pairs, count(*) FILTER (resolved = 'single') AS n_single, count(*) FILTER (resolved = 'date') AS n_by_date, count(*) FILTER (resolved = 'chooser') AS n_by_chooser, CAST(sum(n_edges - 1) AS BIGINT) AS n_dropped FROM k")
def pair_resolution_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.resolution_counts(_pairs(spark, d)[1])


@_r.query(f"SELECT edge_id, array_to_string({_URLS}, '|') AS wikipedia_urls FROM global_network_edges")
def url_domain_filter(spark: SparkSession, d: str) -> DataFrame:
    return R.clean_edges(table(spark, d, "global_network_edges"), DOMAIN).select("edge_id", joined("wikipedia_urls").alias("wikipedia_urls"))


_TITLE = r"""replace(CASE WHEN regexp_matches(u, 'title=[^&]') THEN url_decode(replace(regexp_extract(u, 'title=([^&]+)', 1), '+', '%2B'))
WHEN u LIKE '%/wiki/%' THEN url_decode(replace(regexp_extract(u, '.*/wiki/([^?#]*)', 1), '+', '%2B')) END, '_', ' ')"""
from .entity_queries import FINAL_SQL, final_nodes  # noqa: E402


@_r.query(f"""
WITH {FINAL_SQL},
m AS (SELECT edge_id, source, target, {rel('relationship')} AS relationship, context, CASE WHEN {absent('time_period')} THEN NULL ELSE time_period END AS time_period, {_URLS} AS us FROM global_network_edges)
SELECT source, target, CASE relationship WHEN 'alliance' THEN 'allied_with' ELSE 'rivals_with' END AS type, coalesce(context, '') AS descriptions, time_period,
  array_to_string(list_transform(us, lambda u: coalesce({_TITLE}, 'Wikipedia')), '|') AS titles
FROM m WHERE relationship IN ('alliance', 'rivalry') AND source IN (SELECT standard_name FROM fin) AND target IN (SELECT standard_name FROM fin)""")
def final_relations(spark: SparkSession, d: str) -> DataFrame:
    rows = R.final_relations(R.clean_edges(table(spark, d, "global_network_edges"), DOMAIN), final_nodes(spark, d).select(F.col("standard_name").alias("name")))
    return rows.select("source", "target", "type", joined("descriptions").alias("descriptions"), "time_period", F.array_join(F.transform("sources", lambda s: s["title"]), "|").alias("titles"))


QUERIES, SQL = _r.queries, _r.sql
