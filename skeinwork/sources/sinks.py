"""Writers: tables, article records, network documents, versions that keep what they replace."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Nodes and edges of a network that is written as one document.
DOCUMENT_ROWS = 200_000


def write_index(df: DataFrame, path: str) -> None:
    """CSV with a header; the committer makes the replacement atomic for readers of the directory."""
    df.select("title", "folder_name", "url").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_articles(df: DataFrame, path: str, files: int = 200) -> None:
    """Article texts as Parquet in a bounded number of files, not a file for each article."""
    df.coalesce(files).write.mode("overwrite").parquet(path)


def write_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines; characters beyond ASCII stay as they are."""
    df.write.mode("overwrite").json(path)


def network_document(nodes: DataFrame, edges: DataFrame, description: str = "") -> DataFrame:
    """One row `value`: a JSON document with metadata, nodes and edges. It is one string, so for networks that fit one: `write_network` counts them first."""
    n = nodes.agg(F.count(F.lit(1)).alias("total_nodes"), F.array_sort(F.collect_list(F.struct(*nodes.columns))).alias("nodes"))
    e = edges.agg(F.count(F.lit(1)).alias("total_edges"), F.array_sort(F.collect_list(F.struct(*edges.columns))).alias("edges"))
    meta = F.struct(F.lit(description).alias("description"), "total_nodes", "total_edges")
    return n.crossJoin(e).select(F.to_json(F.struct(meta.alias("metadata"), "nodes", "edges")).alias("value"))


def write_network(nodes: DataFrame, edges: DataFrame, path: str, description: str = "", most: int = DOCUMENT_ROWS) -> bool:
    """One JSON document where nodes and edges, counted, are at most `most`; beyond, a folder each of nodes, edges and metadata. Whether it is one document."""
    n, e = nodes.count(), edges.count()
    if n + e <= most:
        network_document(nodes, edges, description).coalesce(1).write.mode("overwrite").text(path)
        return True
    nodes.write.mode("overwrite").json(f"{path}/nodes")
    edges.write.mode("overwrite").json(f"{path}/edges")
    nodes.sparkSession.createDataFrame([(description, n, e)], "description string, total_nodes bigint, total_edges bigint").write.mode("overwrite").json(f"{path}/metadata")
    return False


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_with_backup(df: DataFrame, path: str) -> str | None:
    """Write beside, move the old version to path.bak-ID, move the new one in; the backup's path, or None where there was nothing.

    The rows are written before anything moves, so df may read path itself, and a failed job leaves it as it was.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:12]
    fresh, backup = f"{path}.new-{tag}", f"{path}.bak-{tag}"
    df.write.parquet(fresh)
    target, fs = _fs(spark, path)
    had = fs.exists(target)
    if had:
        fs.rename(target, _fs(spark, backup)[0])
    fs.rename(_fs(spark, fresh)[0], target)
    return backup if had else None


def append_done(df: DataFrame, path: str) -> None:
    """Add finished results; each task commits its own, and readers resume with an anti join."""
    df.write.mode("append").parquet(path)


def report(df: DataFrame, rows: int = 20) -> str:
    """The text of a table for a log."""
    return df._show_string(rows, 60)
