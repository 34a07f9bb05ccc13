"""Queries of counts, shares, coverage, top lists and the viewer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import fold_name, strip_space
from ..functions.text import display_label
from ..operators import census as C
from ..operators.entities import strings
from ..operators.graph import centrality as Z
from ..operators.graph import layers as L
from ..operators.joins import hot_values, shuffled, spread_join
from .common import EDGES, Registry, both, degree, fold, layer, signed, table, vertex_types, TYPES
from .graph_queries import RECORDS_SQL, VIEWS, betweenness, entities, folded, published_sql, records

_r = Registry()


@_r.query("SELECT coalesce(type, 'none') AS type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM global_network_nodes GROUP BY 1")
def type_histogram(spark: SparkSession, d: str) -> DataFrame:
    return C.histogram(table(spark, d, "global_network_nodes"), F.coalesce("type", F.lit("none")), "type")


@_r.query("SELECT coalesce(relationship, 'none') AS relationship, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM global_network_edges GROUP BY 1")
def relationship_histogram(spark: SparkSession, d: str) -> DataFrame:
    return C.histogram(table(spark, d, "global_network_edges"), F.coalesce("relationship", F.lit("none")), "relationship")


@_r.query("SELECT detail, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM global_network_edges WHERE detail IS NOT NULL GROUP BY 1")
def detail_histogram(spark: SparkSession, d: str) -> DataFrame:
    return C.histogram(table(spark, d, "global_network_edges").filter("detail is not null"), F.col("detail"), "detail")


_ENDS = f"SELECT n AS name FROM (SELECT {fold('source')} AS n FROM global_network_edges UNION ALL SELECT {fold('target')} FROM global_network_edges) WHERE n <> ''"


def _ends(spark: SparkSession, d: str) -> DataFrame:
    return C.endpoint_degree(table(spark, d, "global_network_edges"), fold_name(F.col("source")), fold_name(F.col("target")))


@_r.query(f"SELECT name, count(*) AS n FROM ({_ENDS}) GROUP BY 1")
def endpoint_degree(spark: SparkSession, d: str) -> DataFrame:
    return _ends(spark, d)


@_r.query(f"SELECT name, count(*) AS n FROM ({_ENDS}) GROUP BY 1 ORDER BY n DESC, name LIMIT 10")
def top_connected(spark: SparkSession, d: str) -> DataFrame:
    return C.top(_ends(spark, d), 10, F.desc("n"), F.asc("name"))


@_r.query("SELECT node_id, standard_name, len(source_articles) AS n FROM global_network_nodes WHERE source_articles IS NOT NULL ORDER BY n DESC, node_id LIMIT 10")
def top_mentions(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "global_network_nodes").filter("source_articles is not null").select("node_id", "standard_name", F.size("source_articles").cast("bigint").alias("n"))
    return C.top(n, 10, F.desc("n"), F.asc("node_id"))


@_r.query("SELECT count(*) AS n, count(*) FILTER (k > 0) AS n_with, round(avg(CAST(k > 0 AS INTEGER)), 6) AS coverage, CAST(min(k) AS INTEGER) AS min_size, CAST(max(k) AS INTEGER) AS max_size, round(avg(k), 6) AS mean_size FROM (SELECT len(coalesce(wikipedia_urls, [])) AS k FROM global_network_nodes)")
def coverage_stats(spark: SparkSession, d: str) -> DataFrame:
    return C.array_sizes(table(spark, d, "global_network_nodes"), "wikipedia_urls")


@_r.query("SELECT coalesce(evidence, 'none') AS kind, count(*) AS n, round(avg(CAST(coalesce(context, '') = '' OR contains(lower(context), 'infobox') AS INTEGER)), 6) AS infobox_share, round(avg(CAST(len(coalesce(wikipedia_urls, [])) >= 2 AS INTEGER)), 6) AS multi_source_share FROM global_network_edges GROUP BY 1")
def edge_type_share(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "global_network_edges")
    texts = F.when(F.coalesce("context", F.lit("")) != "", F.array("context")).otherwise(F.array().cast("array<string>"))
    return C.edge_shares(e.select(F.coalesce("evidence", F.lit("none")).alias("kind"), texts.alias("descriptions"), strings(F.col("wikipedia_urls")).alias("sources")), "kind")


@_r.query("SELECT value, count(*) AS n FROM (SELECT unnest(source_articles) AS value FROM global_network_nodes) GROUP BY 1")
def exploded_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.exploded_counts(table(spark, d, "global_network_nodes"), "source_articles")


@_r.query("SELECT type, CAST(rank AS INTEGER) AS rank, node_id, n FROM (SELECT type, node_id, len(coalesce(source_articles, [])) AS n, row_number() OVER (PARTITION BY type ORDER BY len(coalesce(source_articles, [])) DESC, node_id) AS rank FROM global_network_nodes) WHERE rank <= 5")
def top_per_type(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "global_network_nodes").select("type", "node_id", F.size(strings(F.col("source_articles"))).cast("bigint").alias("n"))
    return C.top_per_group(n, "type", 5, F.desc("n"), F.asc("node_id"))


@_r.query("SELECT edge_id, source, target FROM global_network_edges ORDER BY lower(strip(source)) NULLS FIRST, lower(strip(target)) NULLS FIRST, edge_id")
def edges_sorted(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "global_network_edges").select("edge_id", "source", "target")
    return e.orderBy(F.lower(strip_space("source")), F.lower(strip_space("target")), "edge_id")


@_r.query("SELECT DISTINCT type, array_to_string(list_transform(string_split(replace(type, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label FROM type_list")
def display_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "type_list").select("type", display_label(F.col("type")).alias("label")).distinct()


# ---- the viewer


@_r.query(f"WITH {EDGES} SELECT edge_id, s AS source, t AS target FROM e WHERE rel = 'alliance'")
def viewer_layer(spark: SparkSession, d: str) -> DataFrame:
    return signed(spark, d).filter("relationship = 'alliance' and source <> '' and target <> '' and source <> target").select("edge_id", "source", "target")


_SEARCH = "gang"


@_r.query(f"SELECT bw.v AS name, type, betweenness FROM ({published_sql('combined')}) bw JOIN (WITH {EDGES}, {TYPES} SELECT v, type FROM ty) USING (v) WHERE contains(bw.v, '{_SEARCH}') ORDER BY betweenness DESC, name")
def viewer_search(spark: SparkSession, d: str) -> DataFrame:
    """Published organisations whose names hold a text, those most between others first."""
    f = folded(spark, d, in_order=False)
    ranks = Z.betweenness(f.published(None)).select("v", F.round("betweenness", 6).alias("betweenness"))
    rows = entities(f.types).filter(F.contains("v", F.lit(_SEARCH))).join(shuffled(ranks), "v", "left")
    return rows.select(F.col("v").alias("name"), "type", F.coalesce("betweenness", F.lit(0.0)).alias("betweenness")).orderBy(F.desc("betweenness"), "name")


@_r.query(" UNION ALL ".join(f"SELECT view, v AS name, round(2 + 40 * betweenness, 4) AS size FROM ({published_sql(view)})" for view in VIEWS))
def viewer_sizes(spark: SparkSession, d: str) -> DataFrame:
    """What a node is drawn with under each filter: a base and a multiple of its betweenness there."""
    return betweenness(spark, d).select("view", F.col("v").alias("name"), F.round(2 + 40 * F.col("betweenness"), 4).alias("size"))


_TOP = "(SELECT v FROM dg ORDER BY neighbours DESC, v LIMIT 1)"


@_r.query(f"WITH {EDGES}, {layer('l', None)}, {both('bw', 'l')}, {degree('dg', 'bw')}, nb AS (SELECT w FROM bw WHERE v = {_TOP} UNION SELECT v FROM {_TOP}) SELECT a, b, m FROM l WHERE a IN (SELECT w FROM nb) AND b IN (SELECT w FROM nb)")
def ego_network(spark: SparkSession, d: str) -> DataFrame:
    edges = L.layer(signed(spark, d))
    top = L.degrees(edges).orderBy(F.desc("neighbours"), "v").first()
    return L.ego(edges, top["v"] if top else "")


@_r.query(f"""WITH {EDGES}, {TYPES}, {RECORDS_SQL}, o AS (SELECT s AS v, t AS w, edge_id, rel FROM e UNION ALL SELECT t, s, edge_id, rel FROM e)
SELECT v AS name, type, description, edge_id, w AS other, rel AS relationship, x.context, x.evidence, coalesce(array_to_string(x.wikipedia_urls, '|'), '') AS sources FROM ty JOIN nd USING (v) LEFT JOIN o USING (v) LEFT JOIN global_network_edges x USING (edge_id)""")
def entity_details(spark: SparkSession, d: str) -> DataFrame:
    """The panel of every organisation: its record, and each of its edges with texts, evidence and sources; a row an edge, so hubs are no single row."""
    e = signed(spark, d).filter("source <> '' and target <> '' and source <> target")
    ends = F.explode(F.array(F.struct(F.col("source").alias("v"), F.col("target").alias("other")), F.struct(F.col("target").alias("v"), F.col("source").alias("other"))))
    rows = e.select(ends.alias("x"), "edge_id", "relationship").select("x.v", "x.other", "edge_id", "relationship")
    told = table(spark, d, "global_network_edges").select("edge_id", "context", "evidence", F.array_join("wikipedia_urls", "|").alias("sources"))
    own = vertex_types(spark, d).join(shuffled(records(spark, d).select("v", "description")), "v")
    panels = spread_join(rows.join(shuffled(told), "edge_id"), own, "v", hot_values(rows, "v", rows.count()))
    alone = own.join(shuffled(rows.select("v").distinct()), "v", "left_anti")
    out = panels.unionByName(alone, allowMissingColumns=True)
    return out.select(F.col("v").alias("name"), "type", "description", "edge_id", "other", "relationship", "context", "evidence", F.coalesce("sources", F.lit("")).alias("sources"))


QUERIES, SQL = _r.queries, _r.sql
