"""Queries of addresses, article texts, chunks, evidence and incremental runs."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions.names import strip_space, word_count
from ..functions.records import coerce_country, country_prompt
from ..operators import census as C
from ..operators import models as M
from ..operators.entities import final_entities as build_entities
from ..operators.evidence import pick_text
from ..operators.joins import hot_values, spread_join
from ..scratch import Scratch
from ..sources import files, sinks
from ..streaming import ingest as S
from .common import WS, Registry, table
from .entity_queries import final_nodes

_r = Registry()


def _words(c: str) -> str:
    return f"len(regexp_extract_all({c}, '[^{WS}]+'))"


def _decode(c: str) -> str:
    return f"replace(url_decode(replace({c}, '+', '%2B')), '_', ' ')"


@_r.query(f"""SELECT url, nullif(regexp_extract(url, '^https?://([^./]+)\\.', 1), '') AS lang,
{_decode("coalesce(nullif(regexp_extract(url, '^https?://[^/]+/wiki/([^?#]+)', 1), ''), nullif(regexp_extract(url, '[?&]title=([^&#]+)', 1), ''))")} AS title,
TRY_CAST(nullif(regexp_extract(url, '[?&]oldid=([0-9]+)', 1), '') AS BIGINT) AS oldid FROM articles""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "articles").select("url", U.language(u).alias("lang"), U.parse_title(u).alias("title"), U.revision(u).alias("oldid"))


_SLUG = "trim(regexp_replace(regexp_replace(regexp_replace(title, '\\s', '_', 'g'), '[\\\\/:*?\"<>|\\x00-\\x1f]', '_', 'g'), '_+', '_', 'g'), '_')"


@_r.query(f"SELECT title, {_SLUG} AS slug FROM articles")
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("title", U.slug(F.col("title")).alias("slug"))


@_r.query("SELECT title, oldid, 'https://en.wikipedia.org/w/index.php?title=' || url_encode(replace(title, ' ', '_')) || '&oldid=' || oldid AS versioned FROM (SELECT title, TRY_CAST(nullif(regexp_extract(url, '[?&]oldid=([0-9]+)', 1), '') AS BIGINT) AS oldid FROM articles)")
def versioned_url(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select("title", U.revision(F.col("url")).alias("oldid"))
    return a.withColumn("versioned", U.versioned(F.lit("en"), F.col("title"), F.col("oldid")))


@_r.query("""WITH k AS (SELECT *, nullif(regexp_extract(url, '^https?://([^./]+)\\.', 1), '') AS lang FROM articles),
f AS (SELECT *, row_number() OVER (PARTITION BY lang, lower(title) ORDER BY fetched_at, url, folder_name) AS n FROM k)
SELECT title, folder_name, url, fetched_at FROM f WHERE n = 1 OR lang IS NULL OR title IS NULL""")
def slug_dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles")
    return C.keep_first(a, [U.language(F.col("url")), F.lower("title")], F.struct("fetched_at", "url", "folder_name"))


@_r.query(f"SELECT content_id, {_words('content')} AS n_words FROM article_content")
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "article_content").select("content_id", word_count(F.col("content")).cast("bigint").alias("n_words"))


_HEADS = "|".join(T.CUT_HEADINGS)
_CUT = f"regexp_replace(content, '\\n[{WS}]*(?:{_HEADS})[{WS}]*\\n.*', '', 'is')"
_CITE = T.CITATIONS.replace("\\d", "[0-9]")


@_r.query(f"SELECT content_id, {_CUT} AS content FROM article_content")
def section_cut(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "article_content").select("content_id", T.cut_sections(F.col("content")).alias("content"))


@_r.query(f"SELECT content_id, regexp_replace(content, '{_CITE}', '', 'g') AS content FROM article_content")
def citation_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "article_content").select("content_id", T.strip_citations(F.col("content")).alias("content"))


_UNCITED = f"regexp_replace({_CUT}, '{_CITE}', '', 'g')"
_ENDS = r"\r\n|[\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
_BLANKS = WS.replace(r"\n", "")


def _clean(c: str) -> str:
    lines = f"regexp_replace({c}, '{_ENDS}', chr(10), 'g')"
    ends = f"regexp_replace({lines}, '[{_BLANKS}]+(\\n|$)', '\\1', 'g')"
    return f"strip(regexp_replace({ends}, '\\n{{3,}}', chr(10) || chr(10), 'g'))"


@_r.query(f"SELECT content_id, {_clean(_UNCITED)} AS content FROM article_content")
def clean_article(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "article_content").select("content_id", T.clean_article(F.col("content")).alias("content"))


_PARAS = "list_filter(list_transform(regexp_split_to_array(content, '\\n{2,}'), lambda p: strip(p)), lambda p: p <> '')"


@_r.query(f"SELECT content_id, i AS paragraph_no, ps[i] AS paragraph FROM (SELECT content_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT content_id, {_PARAS} AS ps FROM article_content))")
def paragraph_explode(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "article_content").select("content_id", F.posexplode(T.paragraphs(F.col("content"))).alias("at", "paragraph"))
    return rows.select("content_id", (F.col("at") + 1).cast("bigint").alias("paragraph_no"), "paragraph")


CHUNKED = f"""WITH RECURSIVE p AS (SELECT content_id, {_PARAS} AS ps FROM article_content),
n AS (SELECT content_id, list_transform(ps, lambda x: {_words('x')}) AS ns FROM p WHERE len(ps) > 0),
w AS (SELECT content_id, ns, 1 AS i, 1 AS chunk_no, ns[1] AS total FROM n
  UNION ALL SELECT content_id, ns, i + 1, CASE WHEN total + ns[i + 1] > 2500 THEN chunk_no + 1 ELSE chunk_no END, CASE WHEN total + ns[i + 1] > 2500 THEN ns[i + 1] ELSE total + ns[i + 1] END FROM w WHERE i < len(ns))"""


@_r.query(CHUNKED + " SELECT content_id, chunk_no, CAST(max(total) AS BIGINT) AS n_words FROM w GROUP BY 1, 2")
def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    return T.chunks(table(spark, d, "article_content"), "content_id", "content").select("content_id", "chunk_no", F.col("n_words").cast("bigint").alias("n_words"))


_LIST = f"regexp_extract_all(content, '[^{WS}]+')"


@_r.query(f"SELECT content_id, CASE WHEN len({_LIST}) > 300 THEN array_to_string({_LIST}[1:300], ' ') END AS lead FROM article_content")
def lead_context(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "article_content").select("content_id", T.lead(F.col("content")).alias("lead"))


@_r.query(f"SELECT content_id, CASE WHEN len({_LIST}) <= 8000 THEN content ELSE array_to_string({_LIST}[1:8000], ' ') || chr(10) || '[... article truncated ...]' END AS content FROM article_content")
def cap_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "article_content").select("content_id", T.cap_words(F.col("content")).alias("content"))


_MENTION = "array_to_string(list_filter(regexp_split_to_array({c}, '\\n{{2,}}'), lambda p: contains(lower(p), lower(strip({n})))), chr(10) || chr(10))"


@_r.query(f"""SELECT source_file, standard_name, content_id, {_MENTION.format(c='content', n='standard_name')} AS passages
FROM (SELECT DISTINCT source_file, standard_name FROM extracted WHERE strip(standard_name) <> '') JOIN article_content ON folder_name = source_file WHERE content IS NOT NULL""")
def mention_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "extracted").select("source_file", "standard_name").filter(strip_space("standard_name") != "").distinct()
    texts = table(spark, d, "article_content").filter("content is not null").select(F.col("folder_name").alias("source_file"), "content_id", "content")
    # an article that very many names are from is spread over tasks
    return spread_join(names, texts, "source_file", hot_values(names, "source_file", names.count())).select("source_file", "standard_name", "content_id", T.mentioning(F.col("content"), F.col("standard_name")).alias("passages"))


def _contents(spark: SparkSession, d: str) -> DataFrame:
    """One text a folder, the one fetched last."""
    c = table(spark, d, "article_content").filter("content is not null")
    return c.groupBy("folder_name").agg(F.max_by("content", F.struct("fetched_at", "content_id")).alias("content"))


def _tiers(spark: SparkSession, d: str) -> DataFrame:
    nodes = final_nodes(spark, d)
    first = nodes.groupBy("standard_name").agg(F.min_by(F.struct("type", "aliases", "context", "time_period", "wikipedia_urls"), "node_id").alias("n")).select("standard_name", "n.*")
    entities = build_entities(first)
    return pick_text(entities, table(spark, d, "articles"), _contents(spark, d))


@_r.query()
def text_tier_pick(spark: SparkSession, d: str) -> DataFrame:
    return _tiers(spark, d).select("name", "type", "method", word_count(F.col("text")).alias("n_words"))


@_r.query()
def country_prompts(spark: SparkSession, d: str) -> DataFrame:
    return _tiers(spark, d).select("name", "method", country_prompt(F.col("name"), F.col("type"), F.col("method"), F.col("text")).alias("prompt"))


class CountStub:
    """Stands in for a model where none can be asked: counts what it is given, the same each time."""

    def __call__(self, prompt: str, max_tokens: int) -> tuple[str, bool]:
        name = re.search("^Title: (.*)$", prompt, re.M)[1]
        node = {"standard_name": name, "original_text_name": name, "aliases": [], "type": "gang", "context": str(len(prompt)), "time_period": None}
        return "```json\n" + json.dumps({"nodes": [node], "edges": []}) + "\n```", False


@_r.query("""WITH c AS (SELECT content_id, folder_name FROM article_content WHERE content IS NOT NULL AND regexp_matches(content, '\\S')),
f AS (SELECT DISTINCT folder_name FROM c WHERE folder_name IN (SELECT folder_name FROM articles))
SELECT folder_name, CAST(0 AS INTEGER) AS failed_chunks, false AS incomplete FROM f""")
def extraction_run(spark: SparkSession, d: str) -> DataFrame:
    index = table(spark, d, "articles").groupBy("folder_name").agg(F.max_by(F.struct("title", "url"), F.struct("fetched_at", "url")).alias("a")).select("folder_name", "a.*")
    texts = _contents(spark, d).filter(F.col("content").rlike(r"\S"))
    chunked = T.chunks(texts, "folder_name", "content")
    prompts = M.extraction_prompts(chunked, index.join(texts, "folder_name"))
    return M.extractions(M.call_model(prompts, "prompt", CountStub)).select("folder_name", "failed_chunks", "incomplete")


@_r.query("""SELECT node_id, coalesce(nullif(strip(type), ''), 'Unknown') AS country,
array_to_string(CASE WHEN coalesce(nullif(strip(type), ''), 'Unknown') <> 'Unknown' AND NOT list_contains(a, coalesce(nullif(strip(type), ''), 'Unknown')) THEN list_prepend(coalesce(nullif(strip(type), ''), 'Unknown'), a) ELSE a END, '|') AS active,
CASE WHEN lower(strip(time_period)) IN ('low', 'medium', 'high') THEN lower(strip(time_period)) ELSE 'low' END AS confidence
FROM (SELECT *, list_filter(list_transform(coalesce(aliases, []), lambda x: strip(x)), lambda x: x <> '') AS a FROM global_network_nodes)""")
def record_coercion(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "global_network_nodes")
    answer = F.struct(F.col("type").alias("country"), F.col("aliases").alias("countries_active"), F.col("time_period").alias("confidence"))
    return n.withColumn("r", coerce_country(answer)).select("node_id", "r.country", F.array_join("r.countries_active", "|").alias("active"), "r.confidence")


@_r.query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def json_props_extract(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.from_json("props", "k bigint")["k"].alias("k"), "value")
    return e.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@_r.query("SELECT DISTINCT folder_name, title FROM articles WHERE folder_name NOT IN (SELECT folder_name FROM article_content WHERE folder_name IS NOT NULL)")
def coverage_antijoin_resume(spark: SparkSession, d: str) -> DataFrame:
    return files.unfinished(table(spark, d, "articles").select("folder_name", "title").distinct(), table(spark, d, "article_content"), "folder_name")


def _record_files(spark: SparkSession, d: str) -> tuple[Scratch, str]:
    scratch = Scratch(spark, "records")
    x = table(spark, d, "extracted").select("source_file", F.struct("standard_name", "original_text_name", "aliases", "type", "context", "time_period").alias("n"))
    records = x.groupBy("source_file").agg(F.collect_list("n").alias("nodes")).select("nodes", F.array().cast(f"array<{M.EDGE}>").alias("edges"), "source_file")  # the record of one article
    path = scratch.path() + "/extracted"
    sinks.write_records(records, path)
    return scratch, path


@_r.query("SELECT source_file, count(*) AS n FROM extracted GROUP BY 1")
def record_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Records written as JSON and read back by the reader with its quarantine."""
    _, path = _record_files(spark, d)
    records = spark.read.schema(files.RECORD).json(path).filter("_corrupt is null")
    return records.select("source_file", F.size("nodes").cast("bigint").alias("n"))


@_r.query("SELECT standard_name, count(*) AS n FROM extracted GROUP BY 1")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Mentions read as a stream that stops when all files are taken, appended to a table, and counted."""
    scratch = Scratch(spark, "stream")
    source = table(spark, d, "extracted")
    stream = S.new_records(spark, f"{d}/extracted.parquet", source.schema)
    out = scratch.path()
    S.ingest(stream, out, scratch.path()).awaitTermination()
    return spark.read.schema(source.schema).parquet(out).groupBy("standard_name").agg(F.count(F.lit(1)).alias("n"))


QUERIES, SQL = _r.queries, _r.sql
