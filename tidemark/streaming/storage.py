"""Small files and folder listings through Spark's own file systems (any Hadoop-compatible store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in order."""
    path, fs = _path(spark, pattern)
    return sorted(str(s.getPath()) for s in (fs.globStatus(path) or ()))


def complete(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob and were written in full."""
    return [p.rpartition("/")[0] for p in listed(spark, f"{pattern}/_SUCCESS")]


def stamped(spark: SparkSession, pattern: str) -> dict[str, int]:
    """The same, with the time at which each was finished."""
    path, fs = _path(spark, f"{pattern}/_SUCCESS")
    return {str(s.getPath().getParent()): s.getModificationTime() for s in (fs.globStatus(path) or ())}


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, complete or absent: written beside its place and renamed."""
    p, fs = _path(spark, path)
    part, _ = _path(spark, f"{p.getParent()}/.{p.getName()}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    fs.rename(part, p)
