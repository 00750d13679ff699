"""A replica kept as an append-only table of folded micro-batches, read through the fold.

Each micro-batch is folded to its last change per key and written to
``changes/writer=<id>/epoch=<n>`` in overwrite mode, so a retried batch replaces its own
folder and never counts twice; nothing else is touched, whatever the table's size.
Readers take folders with a ``_SUCCESS`` file only. The state is the latest row per key of
the newest base and all epochs: the fold is idempotent and ignores arrival order, so
replays under another writer id change nothing.

``compact`` is a batch job that folds all of it into a new base, deletes included. Beside each base stands ``merged/v=<n>``:
the epochs that went into it, with their files, rows and bytes. Readers list the epochs first, then the base, and leave out
what the base has merged; a folder goes only at the next compaction, so a reader that listed it can still read it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fold import ORDER, latest_state
from tidemark.operators.versions import files
from tidemark.streaming.storage import complete, delete, stamped

TREND = "writer string, version long, files long, rows long, bytes long, finished_at long"


def writer_id(checkpoint: str) -> str:
    """The writer of a checkpoint: the same after a restart, another one after the checkpoint is lost."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


class ChangeTable:
    def __init__(self, spark: SparkSession, root: str, key: str | Sequence[str], schema: T.StructType, *,
                 order: Sequence[str] = ORDER):
        self.spark, self.root, self.key, self.schema, self.order = spark, root.rstrip("/"), key, schema, tuple(order)

    def folder(self, epoch: int, writer: str) -> str:
        return f"{self.root}/changes/writer={writer}/epoch={epoch}"

    def _merged(self, base: str) -> set[tuple[str, int]]:
        """The epoch folders that went into a base, and when each was finished; as many as micro-batches between two compactions."""
        read = self.spark.read.schema(TREND).parquet(f"{self.root}/merged/v={base.rpartition('=')[2]}").select("writer", "version", "finished_at")
        return {(self._tail(self.folder(r["version"], r["writer"])), r["finished_at"]) for r in read.collect()}

    def _parts(self) -> tuple[list[str], dict[str, int], list[str]]:
        """(the newest base, if any; the epochs that it hasn't merged; those that it has). Epochs are listed first: one that a
        compaction merges meanwhile is then still there, and in the base as well, which the fold doesn't mind. An epoch
        that was written anew since it was merged counts as not merged."""
        epochs = stamped(self.spark, f"{self.root}/changes/writer=*/epoch=*")
        bases = complete(self.spark, f"{self.root}/base/v=*")[-1:]
        gone = self._merged(bases[0]) if bases else set()
        return bases, {e: at for e, at in epochs.items() if (self._tail(e), at) not in gone}, [e for e, at in epochs.items() if (self._tail(e), at) in gone]

    def _tail(self, folder: str) -> str:
        return "/".join(folder.split("/")[-2:])

    def epochs(self) -> list[str]:
        """Folders of the micro-batches that were written in full and are in no base."""
        return sorted(self._parts()[1])

    def _bases(self) -> list[str]:
        return self._parts()[0]

    def apply(self, changes: DataFrame, epoch: int, *, writer: str = "batch") -> None:
        """Write the last change per key of one micro-batch; the same (writer, epoch) replaces itself."""
        folded = latest_state(changes.select(*self.schema.names), self.key, self.order, keep_deletes=True)
        folded.write.mode("overwrite").parquet(self.folder(epoch, writer))

    def changes(self, *, without: tuple[int, str] | None = None) -> DataFrame:
        """Every stored row: of the newest base and of all epochs; ``without`` the (epoch, writer) that is being written."""
        bases, epochs, _ = self._parts()
        own = None if without is None else self._tail(self.folder(*without))
        paths = [*bases, *[e for e in epochs if self._tail(e) != own]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, *, live: bool = True) -> DataFrame:
        """The current row of every key; with ``live=False`` also the keys whose last change is a delete."""
        return latest_state(self.changes(), self.key, self.order, keep_deletes=not live)

    def files(self) -> DataFrame:
        """file_path, file_size, record_count of the data files behind the state."""
        return files(self.changes())

    def _epoch_sizes(self) -> DataFrame:
        part = lambda name: F.regexp_extract("file_path", rf"/{name}=([^/]+)/", 1)
        return (self.files().where(F.col("file_path").contains("/epoch="))
                .groupBy(part("writer").alias("writer"), part("epoch").cast("long").alias("version"))
                .agg(F.count("*").alias("files"), F.sum("record_count").alias("rows"), F.sum("file_size").alias("bytes")))

    def size_trend(self) -> DataFrame:
        """files, rows and bytes of every micro-batch, by writer and epoch, also of those that a base has merged."""
        merged = complete(self.spark, f"{self.root}/merged/v=*")
        now = self._epoch_sizes()
        # A merged epoch without rows has no files to tell of; one that a replay wrote again counts once, as it is now.
        old = self.spark.read.schema(TREND).parquet(*merged).where("rows > 0") if merged else self.spark.createDataFrame([], TREND)
        newest = old.groupBy("writer", "version").agg(F.max_by(F.struct("files", "rows", "bytes"), "finished_at").alias("x")).select("writer", "version", "x.*")
        return now.unionByName(newest.join(now, ["writer", "version"], "left_anti"))

    def compact(self) -> None:
        """Fold base and epochs into a new base, and remove what the compaction before had already merged."""
        before = complete(self.spark, f"{self.root}/base/v=*")
        bases, epochs, retired = self._parts()
        version = int(bases[0].rpartition("=")[2]) + 1 if bases else 0
        ids = [(e.split("writer=")[1].split("/")[0], int(e.rpartition("=")[2]), at) for e, at in epochs.items()]
        named = self.spark.createDataFrame(ids, "writer string, version long, finished_at long").join(self._epoch_sizes(), ["writer", "version"], "left")
        sizes = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("files", "rows", "bytes")]
        named.select("writer", "version", *sizes, "finished_at").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/merged/v={version:09d}")
        rows = self.spark.read.schema(self.schema).parquet(*bases, *epochs) if bases or epochs else self.spark.createDataFrame([], self.schema)
        latest_state(rows, self.key, self.order, keep_deletes=True).write.mode("overwrite").parquet(f"{self.root}/base/v={version:09d}")
        for folder in [*retired, *[b for b in before if b not in bases]]:
            delete(self.spark, folder)
