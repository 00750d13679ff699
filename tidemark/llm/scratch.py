"""Intermediate tables in the folder all executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local one only for a local master without that setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(made)
    return made


class Scratch:
    """Named Parquet tables of one operator call; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
        """Write ``df`` and read it back: cuts the lineage and survives lost executors.

        ``large_rows``: of many MB each; one a file, so that one at a time is read, and without a codec's buffers outside the heap.
        """
        path = self.path(name)
        (df.write.option("maxRecordsPerFile", 1).option("compression", "none") if large_rows else df.write).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
