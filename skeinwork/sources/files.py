"""Readers for address lists, article folders, extraction records and network documents."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.infobox import infobox_text
from ..functions.names import strip_space
from ..functions.urls import language, revision
from ..operators.models import EDGE, NODE, again

RECORD = f"nodes array<{NODE}>, edges array<{EDGE}>, source_file string, incomplete boolean, failed_chunks int, total_chunks int, _corrupt string"
NETWORK = (
    "metadata struct<description:string,source_articles:bigint,total_nodes:bigint,total_edges:bigint>,"
    " nodes array<struct<standard_name:string,original_text_names:array<string>,aliases:array<string>,type:string,context:string,time_period:string,source_articles:array<string>,wikipedia_urls:array<string>>>,"
    " edges array<struct<source:string,target:string,relationship:string,detail:string,context:string,time_period:string,wikipedia_urls:array<string>>>"
)


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(at, url): first cells that start with http, with an increasing number that gives their order; headers and blanks fall away."""
    cell = F.trim(F.regexp_replace(F.split_part("value", F.lit(","), F.lit(1)), '^"|"$', ""))
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), cell.alias("url")).filter(F.col("url").startswith("http"))


def article_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a CSV file with the header title, folder_name, url."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("title string, folder_name string, url string").csv(path)


def _folder() -> F.Column:
    return F.url_decode(F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), r"\+", "%2B"))


def _texts(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=name).select(_folder().alias("folder_name"), "value")


def article_texts(spark: SparkSession, root: str) -> DataFrame:
    """(folder_name, content, url) of a directory of article folders; url is null where its file is missing."""
    texts = _texts(spark, root, "content.txt").withColumnRenamed("value", "content")
    return texts.join(_texts(spark, root, "url.txt").select("folder_name", strip_space("value").alias("url")), "folder_name", "left")


def extraction_records(spark: SparkSession, root: str, name: str = "extracted.json") -> tuple[DataFrame, DataFrame]:
    """Records of all folders with their folder_name, and the files that are no record: (folder_name, text)."""
    rows = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).option("multiLine", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(RECORD).json(root).withColumn("folder_name", _folder())
    )
    return rows.filter("_corrupt is null").drop("_corrupt"), rows.filter("_corrupt is not null and nodes is null").select("folder_name", F.col("_corrupt").alias("text"))


def tagged(records: DataFrame, urls: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of records, one row each, with folder, place in it, and the address of the article if urls are given."""
    rows = records.join(urls.select("folder_name", "url"), "folder_name", "left") if urls is not None else records.withColumn("url", F.lit(None).cast("string"))
    nodes = rows.select("folder_name", "url", F.posexplode("nodes").alias("at", "n")).select("folder_name", "url", "at", "n.*")
    edges = rows.select("folder_name", "url", F.posexplode("edges").alias("at", "e")).select("folder_name", "url", "at", "e.*")
    return nodes, edges


def network(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a network, written as one document or as folders."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/nodes")
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        parts = spark.createDataFrame([], NETWORK).schema
        return tuple(spark.read.schema(parts[name].dataType.elementType).json(f"{path}/{name}") for name in ("nodes", "edges"))
    doc = spark.read.option("multiLine", True).schema(NETWORK).json(path)
    return doc.select(F.explode("nodes").alias("n")).select("n.*"), doc.select(F.explode("edges").alias("e")).select("e.*")


def unfinished(work: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Work whose key is not among the finished ones, or all of it."""
    return work if force else work.join(done.select(key).distinct(), key, "left_anti")


def failed(records: DataFrame) -> DataFrame:
    """Records to be made again: without a source, or incomplete."""
    return records.filter(F.col("source_file").isNull() | F.coalesce("incomplete", F.lit(False)))


def secret(path: str) -> str:
    """A key from a file; it stays on the driver and in closures, never in a column."""
    with open(path, encoding="utf-8") as f:
        return f.read().strip()


class Wiki(Protocol):
    """A client of the article service."""

    def oldid(self, lang: str, title: str) -> tuple[int | None, str | None]: ...

    def extract(self, lang: str, oldid: int) -> str | None: ...

    def html(self, lang: str, oldid: int) -> str | None: ...


#: Reasons for a missing revision that another try will not change.
LASTING = ("not found", "missing", "invalid title")


def revision_of(client: Wiki, lang: str, title: str, tries: int = 5, wait: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> tuple[int | None, str | None]:
    """A revision, or why there is none. Rate limits wait longer each time, an empty answer is asked for again unless the page is not there."""
    reason: str | None = None
    for attempt in range(1, tries + 1):
        try:
            found, reason = again(lambda: client.oldid(lang, title), tries, sleep=sleep)
        except Exception as e:
            return None, str(e) or type(e).__name__
        if found is not None or any(x in (reason or "") for x in LASTING):
            return found, reason
        if attempt < tries:
            sleep(wait * attempt)
    return None, reason


def resolve_revisions(rows: DataFrame, make_client: Callable[[], Wiki], parallel: int = 1, **options) -> DataFrame:
    """Adds oldid and reason to rows with lang and title; parallel bounds the calls at a time, options are those of revision_of."""
    schema = T.StructType([*rows.schema.fields, T.StructField("oldid", T.LongType()), T.StructField("reason", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            found = [revision_of(client, a, t, **options) for a, t in zip(batch["lang"], batch["title"])]
            yield batch.assign(oldid=pd.array([i for i, _ in found], dtype="Int64"), reason=[r for _, r in found])

    return rows.repartition(parallel).mapInPandas(run, schema)


def fetch_articles(rows: DataFrame, make_client: Callable[[], Wiki], parallel: int = 1, tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Adds content, infobox and error to rows with a versioned url. The text must come, the infobox may be empty; a failure is a row with its error."""
    rows = rows.withColumn("_lang", language(F.col("url"))).withColumn("_id", revision(F.col("url")))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.StringType()) for c in ("content", "infobox", "error"))])

    def one(client: Wiki, lang: str, oldid) -> tuple[str | None, str, str | None]:
        if pd.isna(oldid):
            return None, "", "no revision in the address"
        try:
            text = again(lambda: client.extract(lang, int(oldid)), tries, sleep=sleep)
        except Exception as e:
            return None, "", str(e) or type(e).__name__
        if text is None:
            return None, "", "no text"
        try:
            page = again(lambda: client.html(lang, int(oldid)), tries, sleep=sleep)
        except Exception:  # an infobox is optional
            page = None
        return text, infobox_text(page), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            got = [one(client, a, i) for a, i in zip(batch["_lang"], batch["_id"])]
            yield batch.assign(content=[g[0] for g in got], infobox=[g[1] for g in got], error=[g[2] for g in got])

    return rows.repartition(parallel).mapInPandas(run, schema).drop("_lang", "_id")
