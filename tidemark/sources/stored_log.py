"""A change log as a stored table that time travel prunes: Parquet by commit range, beside it one row per commit.

``log/commit_range=<r>`` holds the changes of ``size`` consecutive commits, ``commits/commit_range=<r>`` their commit rows. A
read as of a time asks the small commits table which commits were visible then; the ranges that hold any of them
prune the log's folders before a file is opened, and only their rows meet the commits. Writing replaces the ranges it brings (all of
their commits so far), so a job that is run again leaves nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.fold import ORDER, latest_state
from tidemark.operators.versions import commits

RANGE = "commit_range"


class StoredLog:
    def __init__(self, spark: SparkSession, root: str, *, size: int = 1000, commit: str = "batch_id", order: Sequence[str] = ORDER):
        self.spark, self.root, self.size, self.commit, self.order = spark, root.rstrip("/"), size, commit, tuple(order)

    def _range(self, c: Column) -> Column:
        return F.floor(c / F.lit(self.size)).cast("long")

    def _write(self, df: DataFrame, part: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE).parquet(f"{self.root}/{part}")

    def write(self, log: DataFrame) -> None:
        """Store whole commit ranges; a range that is there already is replaced. Tasks hold neighbouring commits, so a range is written by few of them."""
        ranged = log.withColumn(RANGE, self._range(F.col(self.commit)))
        self._write(ranged.repartitionByRange(self.commit, *self.order), "log")
        held = commits(log, self.commit, self.order[0])
        self._write(held.withColumn(RANGE, self._range(F.col("commit_id"))).repartitionByRange(RANGE), "commits")

    def commits(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/commits")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/log")

    def visible(self, t_ms: int | Column) -> DataFrame:
        """The changes of all commits up to an instant. The range bounds are scalar subqueries on the partition column: Spark
        runs them on the commits table first and lists only the folders between them."""
        ok = self.commits().filter(F.col("committed_at_ms") <= (t_ms if isinstance(t_ms, Column) else F.lit(t_ms)))
        low, high = (ok.agg(f(RANGE)).scalar() for f in (F.min, F.max))
        near = self.read().filter((F.col(RANGE) >= low) & (F.col(RANGE) <= high))
        return near.join(ok.select(RANGE, F.col("commit_id").alias(self.commit)), [RANGE, self.commit], "left_semi").drop(RANGE)

    def as_of(self, key: str, t_ms: int | Column) -> DataFrame:
        """State that a reader of the replica saw at an instant (commit time)."""
        return latest_state(self.visible(t_ms), key, self.order)

    def as_of_minutes_ago(self, key: str, minutes: int, now_ms: int | Column | None = None) -> DataFrame:
        """The state ``minutes`` before ``now_ms``, or before the newest commit."""
        now = self.commits().agg(F.max("committed_at_ms")).scalar() if now_ms is None else now_ms
        return self.as_of(key, (now if isinstance(now, Column) else F.lit(now)) - F.lit(minutes * 60_000))

    def as_of_version(self, key: str, version: int) -> DataFrame:
        """State after all commits up to ``version``; the bound on the range prunes folders."""
        rows = self.read().filter((F.col(self.commit) <= F.lit(version)) & (F.col(RANGE) <= F.lit(version // self.size)))
        return latest_state(rows.drop(RANGE), key, self.order)

    def with_commit_time(self) -> DataFrame:
        """Every change with its ``committed_at_ms``: a join with the stored commits, not an aggregate of the log."""
        held = self.commits().select(RANGE, F.col("commit_id").alias(self.commit), "committed_at_ms")
        return self.read().join(held, [RANGE, self.commit], "left").drop(RANGE)
