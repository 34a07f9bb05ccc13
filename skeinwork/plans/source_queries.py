"""Queries that run the readers, writers, services and streams, each against SQL on what went in."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.infobox import infobox
from ..functions.names import fold_name
from ..operators import census as C
from ..operators import models as M
from ..operators.entities import strings
from ..operators.evidence import url_index
from ..operators.joins import shuffled
from ..scratch import Scratch
from ..sources import files, sinks
from ..streaming import ingest as S
from .common import EDGES, Registry, fold, signed, table
from .text_queries import CHUNKED

_r = Registry()


def _no_wait(seconds: float) -> None:
    """The stubs answer at once."""


@_r.query("SELECT split_part(url, ',', 1) AS url FROM articles WHERE url LIKE 'http%'")
def address_list(spark: SparkSession, d: str) -> DataFrame:
    """Addresses from a list with a header, blank lines and cells beside them."""
    path = Scratch(spark, "addresses").path()
    lines = table(spark, d, "articles").select(F.explode(F.array(F.lit("url"), F.lit(""), F.concat(F.lit('"'), F.split_part("url", F.lit(","), F.lit(1)), F.lit('",seen')))).alias("value")).filter("value is not null")
    lines.write.text(path)
    return files.url_list(spark, path).select("url")


@_r.query("SELECT title, folder_name, nullif(url, '') AS url FROM articles")
def article_index_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = Scratch(spark, "index").path()
    sinks.write_index(table(spark, d, "articles"), path)
    return files.article_index(spark, path)


@_r.query("SELECT folder_name, content FROM article_content")
def article_table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = Scratch(spark, "texts").path()
    sinks.write_articles(table(spark, d, "article_content").select("folder_name", "content"), path)
    return spark.read.parquet(path)


@_r.query("SELECT count(DISTINCT source_file) AS n_records, count(*) AS n_nodes, 1 AS n_bad FROM extracted WHERE source_file IS NOT NULL")
def extraction_reading(spark: SparkSession, d: str) -> DataFrame:
    """Records in files of folders, read with the quarantine that takes a file that is no record."""
    root = Scratch(spark, "folders").path()
    x = table(spark, d, "extracted").filter("source_file is not null").select("source_file", F.struct("standard_name", "original_text_name", "aliases", "type", "context", "time_period").alias("n"))
    records = x.groupBy("source_file").agg(F.collect_list("n").alias("nodes"))  # the record of one article
    rows = records.select("nodes", F.array().cast(f"array<{M.EDGE}>").alias("edges"), F.xxhash64("source_file").alias("at"))
    rows.repartition("at").write.partitionBy("at").json(f"{root}/good")
    spark.createDataFrame([("{not a record",)], "value string").coalesce(1).write.text(f"{root}/bad")
    good, bad = files.extraction_records(spark, root, "part-*")
    return good.agg(F.count(F.lit(1)).alias("n_records"), F.sum(F.size("nodes")).alias("n_nodes")).crossJoin(bad.agg(F.count(F.lit(1)).cast("int").alias("n_bad")))  # one row each


def _network(spark: SparkSession, d: str, most: int) -> tuple[DataFrame, DataFrame]:
    path = Scratch(spark, "network").path()
    n, e = table(spark, d, "global_network_nodes"), table(spark, d, "global_network_edges")
    nodes = n.select("standard_name", "original_text_names", "aliases", "type", "context", "time_period", "source_articles", "wikipedia_urls")
    edges = e.select("source", "target", "relationship", "detail", "context", "time_period", "wikipedia_urls")
    sinks.write_network(nodes, edges, path, "test", most)
    return files.network(spark, path)


@_r.query("SELECT standard_name, type, coalesce(len(aliases), 0) AS n_aliases FROM global_network_nodes")
def network_document_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes, _ = _network(spark, d, sinks.DOCUMENT_ROWS)
    return nodes.select("standard_name", "type", F.size(strings(F.col("aliases"))).alias("n_aliases"))


@_r.query("SELECT source, target, relationship, detail, context FROM global_network_edges")
def network_folder_edges(spark: SparkSession, d: str) -> DataFrame:
    """The same network beyond the size of one document."""
    _, edges = _network(spark, d, 0)
    return edges.select("source", "target", "relationship", "detail", "context")


@_r.query("SELECT 'backup' AS version, node_id FROM global_network_nodes UNION ALL SELECT 'current', node_id FROM global_network_nodes WHERE type IS NOT NULL")
def replaced_with_backup(spark: SparkSession, d: str) -> DataFrame:
    path = Scratch(spark, "versions").path()
    ids = table(spark, d, "global_network_nodes").select("node_id", "type")
    sinks.replace_with_backup(ids, path)
    backup = sinks.replace_with_backup(spark.read.schema(ids.schema).parquet(path).filter("type is not null"), path)
    parts = [spark.read.schema(ids.schema).parquet(p).select(F.lit(v).alias("version"), "node_id") for v, p in (("backup", backup), ("current", path))]
    return parts[0].unionByName(parts[1])


@_r.query("SELECT node_id FROM global_network_nodes WHERE node_id % 5 NOT IN (0, 1)")
def resumed_work(spark: SparkSession, d: str) -> DataFrame:
    """What is left to do after two appends of finished work."""
    path = Scratch(spark, "done").path()
    work = table(spark, d, "global_network_nodes").select("node_id")
    for rest in (0, 1):
        sinks.append_done(work.filter(F.col("node_id") % 5 == rest), path)
    return files.unfinished(work, spark.read.schema(work.schema).parquet(path), "node_id")


@_r.query("SELECT folder_name FROM article_content WHERE content_id % 7 = 0 OR content_id % 11 = 0")
def failed_records(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "article_content")
    rows = a.select("folder_name", F.when(F.col("content_id") % 7 != 0, F.col("folder_name")).alias("source_file"), F.when(F.col("content_id") % 3 != 0, F.col("content_id") % 11 == 0).otherwise(F.nullif(F.col("content_id") % 11 == 0, F.lit(False))).alias("incomplete"))
    return files.failed(rows).select("folder_name")


@_r.query("SELECT source_file AS folder_name, url, count(*) AS n FROM extracted LEFT JOIN (SELECT folder_name, max(url) AS url FROM articles GROUP BY 1) a ON a.folder_name = source_file GROUP BY 1, 2")
def provenance_tagged(spark: SparkSession, d: str) -> DataFrame:
    """Mentions from records, with the address of their article."""
    x = table(spark, d, "extracted").select(F.col("source_file").alias("folder_name"), F.struct("standard_name", "type").alias("n"))
    records = x.groupBy("folder_name").agg(F.collect_list("n").alias("nodes")).withColumn("edges", F.array().cast(f"array<{M.EDGE}>"))  # the record of one article
    urls = table(spark, d, "articles").groupBy("folder_name").agg(F.max("url").alias("url"))
    nodes, _ = files.tagged(records, urls)
    return nodes.groupBy("folder_name", "url").agg(F.count(F.lit(1)).alias("n"))


class WikiStub:
    """Stands in for the article service: limits the rate of every first call, does not know titles of even length, has no page of odd revisions."""

    def __init__(self):
        self.asked: set = set()

    def _limited(self, *key) -> None:
        if key not in self.asked:
            self.asked.add(key)
            raise RuntimeError("429 too many requests")

    def oldid(self, lang: str, title: str) -> tuple[int | None, str | None]:
        self._limited("oldid", title)
        return (len(title), None) if len(title) % 2 else (None, "not found")

    def extract(self, lang: str, oldid: int) -> str | None:
        self._limited("extract", oldid)
        return f"text {oldid}"

    def html(self, lang: str, oldid: int) -> str | None:
        if oldid % 2:
            raise ValueError("no page")
        return f"<table class='infobox'><caption>Page {oldid}</caption><tr><th>Kind</th><td>a<br>b</td></tr></table>"


@_r.query("SELECT DISTINCT title, CASE WHEN length(title) % 2 = 1 THEN length(title) END AS oldid, CASE WHEN length(title) % 2 = 0 THEN 'not found' END AS reason FROM articles WHERE title IS NOT NULL")
def revision_lookup(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "articles").filter("title is not null").select("title").distinct().withColumn("lang", F.lit("en"))
    return files.resolve_revisions(titles, WikiStub, spark.sparkContext.defaultParallelism, sleep=_no_wait).select("title", "oldid", "reason")


_OLDID = "TRY_CAST(nullif(regexp_extract(url, '[?&]oldid=([0-9]+)', 1), '') AS BIGINT)"


@_r.query(f"""SELECT folder_name, CASE WHEN o IS NOT NULL THEN 'text ' || o END AS content, CASE WHEN o % 2 = 0 THEN 'Page ' || o || chr(10) || 'Kind: a, b' ELSE '' END AS infobox,
CASE WHEN o IS NULL THEN 'no revision in the address' END AS error FROM (SELECT folder_name, {_OLDID} AS o FROM articles)""")
def article_fetch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "articles").select("folder_name", "url")
    return files.fetch_articles(rows, WikiStub, spark.sparkContext.defaultParallelism, sleep=_no_wait).select("folder_name", "content", "infobox", "error")


@_r.query("""SELECT node_id, 'Body' || CASE WHEN node_id % 3 > 0 THEN chr(10) || chr(10) || '--- INFOBOX ---' || chr(10) || chr(10) || 'Node ' || node_id || chr(10) || 'Articles: ' || coalesce(len(source_articles), 0) || ', 2' ELSE '' END AS text FROM global_network_nodes""")
def infobox_block(spark: SparkSession, d: str) -> DataFrame:
    """Pages with tables, of which a third is no infobox, as text with a block."""
    n = F.size(strings(F.col("source_articles"))).cast("string")
    css = F.when(F.col("node_id") % 3 > 0, "infobox vcard").otherwise("wikitable")
    page = F.concat(F.lit("<div><table class='"), css, F.lit("'><tr><th class='title'>Node "), F.col("node_id").cast("string"), F.lit("</th></tr><tr><th>Articles</th><td><ul><li>"), n, F.lit("<sup>[1]</sup></li><li>2</li></ul></td></tr></table></div>"))
    rows = table(spark, d, "global_network_nodes").select("node_id", infobox(page).alias("box"))
    return rows.select("node_id", T.with_infobox(F.lit("Body"), F.col("box")).alias("text"))


@_r.query("SELECT url, max(folder_name) AS folder_name FROM articles WHERE url <> '' GROUP BY 1")
def address_folders(spark: SparkSession, d: str) -> DataFrame:
    return url_index(table(spark, d, "articles"))


_REFS = "SELECT node_id, unnest(list_distinct(list_filter(wikipedia_urls, lambda u: u IS NOT NULL))) AS url FROM global_network_nodes"


@_r.query(f"WITH r AS ({_REFS}), x AS (SELECT url, max(folder_name) AS folder_name FROM articles WHERE url <> '' GROUP BY 1) SELECT node_id, folder_name, count(*) AS n FROM r JOIN x USING (url) JOIN article_content USING (folder_name) WHERE content IS NOT NULL GROUP BY 1, 2")
def mentioning_articles(spark: SparkSession, d: str) -> DataFrame:
    """The texts of the articles that name a node, through its addresses."""
    refs = table(spark, d, "global_network_nodes").select("node_id", F.explode(F.array_distinct(F.filter("wikipedia_urls", lambda u: u.isNotNull()))).alias("url"))
    texts = table(spark, d, "article_content").filter("content is not null").select("folder_name")
    found = refs.join(shuffled(url_index(table(spark, d, "articles"))), "url").join(shuffled(texts), "folder_name")
    return found.groupBy("node_id", "folder_name").agg(F.count(F.lit(1)).alias("n"))


class ChunkStub:
    """Stands in for a model: cuts off what is asked with the first budget for a third of the prompts, and never gives JSON for another."""

    def __call__(self, prompt: str, max_tokens: int) -> tuple[str, bool]:
        kind = sum(map(int, prompt.split("\n", 1)[0].split(":"))) % 3
        return ("{}" if kind else "no JSON", kind == 1 and max_tokens == M.TOKENS[0])


@_r.query(CHUNKED + " SELECT content_id, CAST(count(DISTINCT chunk_no) FILTER ((content_id + chunk_no) % 3 = 0) AS INTEGER) AS failed_chunks, CAST(count(DISTINCT chunk_no) AS INTEGER) AS total_chunks, bool_or((content_id + chunk_no) % 3 = 0) AS incomplete FROM w GROUP BY 1")
def extraction_failures(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of which some fail on every try: their articles are marked incomplete."""
    chunks = T.chunks(table(spark, d, "article_content"), "content_id", "content").select(F.col("content_id").alias("folder_name"), "chunk_no", F.concat_ws(":", "content_id", "chunk_no").alias("prompt"))
    answered = M.call_model(chunks, "prompt", ChunkStub, sleep=_no_wait)
    return M.extractions(answered).select(F.col("folder_name").alias("content_id"), "failed_chunks", "total_chunks", "incomplete")


class CountryStub:
    """Stands in for a model that names countries by the length of a name, and fails for a fifth of them."""

    def __call__(self, prompt: str, max_tokens: int) -> tuple[str, bool]:
        k = len(prompt.split("\n", 1)[0]) % 5
        return ("?" if k == 4 else "```json\n" + json.dumps({"country": f"C{k}", "countries_active": ["C0", f"D{k}"], "confidence": "HIGH" if k else "odd"}) + "\n```"), False


_LANDS = f"n AS (SELECT DISTINCT {fold('standard_name')} AS v FROM global_network_nodes WHERE {fold('standard_name')} <> ''), c AS (SELECT v, length(v) % 5 AS k, length(v) % 2 = 0 AS own FROM n)"


@_r.query(f"""WITH {_LANDS}, r AS (SELECT v, CASE WHEN k = 4 OR NOT own THEN 'Unknown' ELSE 'C' || k END AS country, CASE WHEN k IN (0, 4) OR NOT own THEN 'low' ELSE 'high' END AS confidence, CASE WHEN own THEN 'name_only' ELSE 'none' END AS method,
CASE WHEN k = 4 OR NOT own THEN [] WHEN k = 0 THEN ['C0', 'D0'] ELSE ['C' || k, 'C0', 'D' || k] END AS active FROM c)
SELECT 'country' AS kind, country AS value, count(*) AS n FROM r GROUP BY 2 UNION ALL SELECT 'confidence', confidence, count(*) FROM r GROUP BY 2 UNION ALL SELECT 'method', method, count(*) FROM r GROUP BY 2 UNION ALL SELECT 'active', a, count(*) FROM (SELECT unnest(active) AS a FROM r) GROUP BY 2""")
def country_counts(spark: SparkSession, d: str) -> DataFrame:
    """Half of the organisations are asked for; their answers are joined back to all of them and counted."""
    names = table(spark, d, "global_network_nodes").select(fold_name(F.col("standard_name")).alias("name")).filter("name <> ''").distinct()
    asked = names.filter(F.length("name") % 2 == 0).withColumn("method", F.lit("name_only"))
    found = M.countries(M.call_model(asked, "name", CountryStub, sleep=_no_wait))
    rows = M.with_countries(names, found).withColumn("country_method", F.coalesce("country_method", F.lit("none")))
    kinds = {"country": F.array("country"), "confidence": F.array("country_confidence"), "method": F.array("country_method"), "active": F.col("countries_active")}
    cells = rows.select(F.explode(F.concat(*[F.transform(c, _tag(k)) for k, c in kinds.items()])).alias("x")).select("x.kind", "x.value")
    return cells.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


def _tag(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("value"))


@_r.query(f"WITH {EDGES}, n AS (SELECT {fold('standard_name')} AS v FROM global_network_nodes) SELECT s AS v FROM e UNION SELECT t FROM e EXCEPT SELECT v FROM n WHERE v IS NOT NULL")
def ends_without_node(spark: SparkSession, d: str) -> DataFrame:
    """Ends of edges that are no node: a set difference."""
    e = signed(spark, d).filter("source <> '' and target <> '' and source <> target")
    nodes = table(spark, d, "global_network_nodes").select(fold_name(F.col("standard_name")).alias("v")).filter("v is not null")
    return e.select(F.explode(F.array("source", "target")).alias("v")).subtract(nodes)


@_r.query("SELECT DISTINCT title, url FROM articles WHERE url IS NOT NULL")
def versioned_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Addresses, as they go into the index, each once."""
    return C.keep_first(table(spark, d, "articles").filter("url is not null").select("title", "url"), [F.col("title"), F.col("url")], F.col("url"), pass_null=False)


@_r.query("SELECT count(DISTINCT mention_id) AS n, count(DISTINCT mention_id) AS n_ids FROM extracted")
def stream_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Mentions that are delivered again within the lateness come once out of the stream."""
    scratch = Scratch(spark, "deliveries")
    schema = table(spark, d, "extracted").schema
    stream = S.new_records(spark, f"{d}/extracted.parquet", schema).filter("mention_id is not null").select("mention_id", F.col("loaded_at").cast("timestamp").alias("loaded_at"))
    out = scratch.path()
    S.ingest(S.deliveries(stream, "mention_id", "loaded_at", "3650 days"), out, scratch.path()).awaitTermination()
    return spark.read.schema("mention_id bigint, loaded_at timestamp").parquet(out).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("mention_id").alias("n_ids"))


QUERIES, SQL = _r.queries, _r.sql
