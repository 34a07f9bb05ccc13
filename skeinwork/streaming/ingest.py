"""Incremental runs: new files only, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_records(spark: SparkSession, path: str, schema: StructType, form: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """A stream of the files of a directory, or of one file, for runs that take what is new and stop."""
    reader = spark.readStream.schema(schema).format(form).option("maxFilesPerTrigger", files_per_batch)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():  # the source wants a directory
        return reader.option("pathGlobFilter", p.getName()).load(p.getParent().toString())
    return reader.load(path)


def ingest(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to a table, exactly once, and stop. A run after it goes on from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def deliveries(stream: DataFrame, key: str, loaded: str, lateness: str = "30 days") -> DataFrame:
    """Each key once within the lateness that deliveries may have."""
    return stream.withWatermark(loaded, lateness).dropDuplicatesWithinWatermark([key])


def mention_counts(stream: DataFrame, at: str = "extracted_at", width: str = "7 days", lateness: str = "30 days") -> DataFrame:
    """Mentions per name and window of event time, late ones counted up to the lateness."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, width), "standard_name").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("from"), "standard_name", "n")
