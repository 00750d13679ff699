"""Change rates as streams: counts that keep their late rows, and sliding windows by chained aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.apply import _trigger
from tidemark.streaming.storage import complete, delete

LATE = ("epoch", "watermark_ms")


class RateTable:
    """Windowed change counts of a stream in which every row is either counted or kept as late.

    A micro-batch's watermark is the newest event time of all earlier ones less ``delay_ms``; it is stored
    with each epoch, so that a retried or restarted query judges its rows as before. Rows behind it, and rows without an event time,
    go to ``late`` as they came, with the epoch and its watermark. The others are counted per window, and
    each epoch's counts are stored on their own. All folders of an epoch are written in overwrite mode: a retry leaves nothing twice.

    ``generation`` names the run of a checkpoint: after a lost one pass a higher generation, and readers take that alone.
    """

    def __init__(self, spark: SparkSession, root: str, *, window_ms: int, delay_ms: int, by: Sequence[str] = (), ts: str = "ts_ms", generation: int = 0):
        self.spark, self.root = spark, root.rstrip("/")
        self.window_ms, self.delay_ms, self.by, self.ts, self.generation = window_ms, delay_ms, tuple(by), ts, generation

    def _folder(self, part: str, epoch: int) -> str:
        return f"{self.root}/{part}/generation={self.generation}/epoch={epoch}"

    def _newest_before(self, epoch: int) -> int | None:
        """The newest event time of all earlier micro-batches: the last one's row holds it."""
        if epoch == 0:
            return None
        return self.spark.read.schema("newest_ms long").parquet(self._folder("newest", epoch - 1)).first()["newest_ms"]

    def apply(self, batch: DataFrame, epoch: int) -> None:
        newest = self._newest_before(epoch)
        watermark = None if newest is None else newest - self.delay_ms
        batch = batch.persist()
        try:
            time = F.col(self.ts)
            late = time.isNull() if watermark is None else time.isNull() | (time < F.lit(watermark))
            (batch.filter(late).withColumns({"epoch": F.lit(epoch).cast("long"), "watermark_ms": F.lit(watermark).cast("long")})
             .write.mode("overwrite").parquet(self._folder("late", epoch)))
            start = (F.floor(time / F.lit(self.window_ms)) * F.lit(self.window_ms)).cast("long")
            (batch.filter(~late).groupBy(start.alias("window_start_ms"), *self.by).agg(F.count(F.lit(1)).alias("n_changes"))
             .write.mode("overwrite").parquet(self._folder("counts", epoch)))
            batch.agg(F.greatest(F.max(time), F.lit(newest).cast("long")).alias("newest_ms")).write.mode("overwrite").parquet(self._folder("newest", epoch))
        finally:
            batch.unpersist()
        if epoch > 1:  # a retry never goes behind the last committed epoch
            delete(self.spark, self._folder("newest", epoch - 2))

    def start(self, stream: DataFrame, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
        w = stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return _trigger(w, trigger).start()

    def _read(self, part: str) -> DataFrame | None:
        folders = complete(self.spark, f"{self.root}/{part}/generation=*/epoch=*")
        newest = max((int(f.split("generation=")[1].split("/")[0]) for f in folders), default=None)
        mine = [f for f in folders if f"/generation={newest}/" in f]
        return self.spark.read.parquet(*mine) if mine else None

    def counts(self) -> DataFrame | None:
        """n_changes per window (and ``by``); None before the first micro-batch."""
        got = self._read("counts")
        return None if got is None else got.groupBy("window_start_ms", *self.by).agg(F.sum("n_changes").alias("n_changes"))

    def late(self) -> DataFrame | None:
        """The rows that came too late for their window, with ``LATE``; None before the first micro-batch."""
        return self._read("late")


def stream_sliding_rate(stream: DataFrame, window: str, slide: str, *, watermark: str = "10 minutes", by: Sequence[str] = (), ts: str = "ts_ms",
                        counted: str = "true") -> DataFrame:
    """Counts of sliding windows in append mode, by two chained aggregations: changes per slide step, then the steps' counts
    per window, so that a row is counted once and not once per window that holds it.

    A window comes out when the watermark has passed its end. Rows for which ``counted`` is false (heartbeats) move the
    watermark and aren't counted, so a quiet topic's last windows come out as well; a window that holds nothing else gives no row.
    """
    timed = stream.withColumn("_event_time", F.timestamp_millis(F.col(ts))).withWatermark("_event_time", watermark)
    steps = (timed.groupBy(F.window("_event_time", slide).alias("_step"), *by)
             .agg(F.count(F.when(F.expr(counted), 1)).alias("_n")))
    slides = F.window(F.window_time("_step"), window, slide)
    return (steps.groupBy(slides.alias("_w"), *by).agg(F.sum("_n").alias("n_changes")).filter("n_changes > 0")
            .select(F.unix_millis("_w.start").alias("window_start_ms"), F.unix_millis("_w.end").alias("window_end_ms"), *by, "n_changes"))
