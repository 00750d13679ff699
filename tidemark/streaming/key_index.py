"""Source primary key -> business key, kept beside a replica whose two keys differ.

Each micro-batch appends the primary keys whose business key it set, changed or ended to
``writer=<id>/epoch=<n>/bucket=<b>`` (overwrite mode: a retry replaces itself); rows that keep their key write nothing. A batch
reads only the buckets of its own primary keys and of those only its own rows, so its cost follows the batch and not the replica.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fold import ORDER, latest_state
from tidemark.streaming.storage import complete, delete

BUCKETS = 256


class KeyIndex:
    def __init__(self, spark: SparkSession, root: str, pk: str, key: str, columns: T.StructType, *, buckets: int = BUCKETS):
        self.spark, self.root, self.pk, self.key, self.buckets = spark, root.rstrip("/"), pk, key, buckets
        kept = [columns[pk], columns[key], T.StructField("op", T.StringType()), *[T.StructField(c, T.LongType()) for c in ORDER]]
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in kept])

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.pk).cast("string")), F.lit(self.buckets)).cast("int")

    def _folders(self) -> list[str]:
        return complete(self.spark, f"{self.root}/writer=*/epoch=*")

    def _read(self, folders: list[str]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(stored).option("basePath", self.root).parquet(*folders)

    def lookup(self, batch: DataFrame, *, without: tuple[int, str] | None = None) -> DataFrame:
        """The stored rows of the batch's primary keys. ``without``: the (epoch, writer) that is being written."""
        own = None if without is None else f"writer={without[1]}/epoch={without[0]}"
        paths = [p for p in self._folders() if own is None or not p.endswith(own)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        asked = batch.select(self.pk).filter(F.col(self.pk).isNotNull()).distinct()
        needed = [r["b"] for r in asked.select(self._bucket().alias("b")).distinct().collect()]  # at most ``buckets`` numbers
        return self._read(paths).filter(F.col("bucket").isin(needed)).select(*self.schema.names).join(asked, self.pk, "left_semi")

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last row per primary key; of a renaming, which deletes the old key and sets the new one at once, the latter."""
        alive = rows.select(self.pk, self.key, "op", *ORDER).withColumn("_alive", F.col("op") != "d")
        return latest_state(alive, self.pk, (*ORDER, "_alive"), keep_deletes=True)

    def _store(self, rows: DataFrame, writer: str, epoch: int) -> None:
        (rows.select(*self.schema.names, self._bucket().alias("bucket")).write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.root}/writer={writer}/epoch={epoch}"))

    def apply(self, changes: DataFrame, known: DataFrame, epoch: int, *, writer: str) -> None:
        """Write the primary keys of a batch whose last row has another key or end than ``known`` says."""
        rows = changes.filter(F.col(self.pk).isNotNull() & F.col(self.key).isNotNull()).select(*self.schema.names)
        now = self._last(rows.unionByName(known.select(*self.schema.names)))
        was = self._last(known).select(self.pk, F.col(self.key).alias("_key"), F.col("_alive").alias("_was_alive"))
        new = now.join(was, self.pk, "left").filter(F.col("_key").isNull() | (F.col("_key") != F.col(self.key)) | (F.col("_was_alive") != F.col("_alive")))
        self._store(new, writer, epoch)

    def _fold(self, rows: DataFrame) -> None:
        old = self._folders()
        n = 1 + max((int(p.rpartition("=")[2]) for p in old if "/writer=compacted/" in p), default=-1)
        self._store(self._last(rows), "compacted", n)
        for p in old:
            delete(self.spark, p)

    def compact(self) -> None:
        """Fold all folders into one; run it while the stream is stopped."""
        if folders := self._folders():
            self._fold(self._read(folders))

    def rebuild(self, rows: DataFrame) -> None:
        """Make the index anew from a replica's rows, deletes included (``ChangeTable.read(live=False)``); run it while the stream is stopped."""
        self._fold(rows.filter(F.col(self.pk).isNotNull()))
