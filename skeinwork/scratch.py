"""Written intermediate tables that survive the loss of executors.

Iterative operators cut their lineage by writing a Parquet table into the folder all executors share
(`spark.checkpoint.dir`). Against `DataFrame.checkpoint()` that computes the rows once, stores them compressed and
columnar, and lets the next round read only the columns it needs.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; one of our own only where it is unset and the master is local."""
    named = spark.sparkContext.getConf().get(_FOLDER) or spark.conf.get(_FOLDER, "")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError(f"set {_FOLDER} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="skeinwork-")
    spark.conf.set(_FOLDER, f"file://{own}")
    return f"file://{own}"


class Scratch:
    """Tables of one run of an operator, under one folder of its own.

    A result may still read them when the operator returns, so they stay until `drop` or the end of the process.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.count = spark, 0
        self.root = f"{shared_folder(spark)}/skeinwork/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def path(self) -> str:
        self.count += 1
        return f"{self.root}/{self.count:04d}"

    def save(self, df: DataFrame) -> DataFrame:
        """Write the rows and return a frame that reads them."""
        path, schema = self.path(), df.schema
        df.write.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out._skein_path = path
        return out

    def read_all(self, *tables: DataFrame) -> DataFrame:
        """One frame over saved tables of one schema: a single scan of their folders, however many they are."""
        paths = [p for t in tables for p in vars(t).get("_skein_paths") or [vars(t)["_skein_path"]]]
        out = self.spark.read.schema(tables[0].schema).parquet(*paths)
        out._skein_paths = paths
        return out

    def drop(self, df: DataFrame | None = None) -> None:
        """Delete one table that nothing reads any more, or the whole folder."""
        target = self.root if df is None else vars(df).get("_skein_path")
        if not target or self.spark.sparkContext._jsc is None:
            return
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(target)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session may have ended before the process
            pass
