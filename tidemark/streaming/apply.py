"""Structured Streaming jobs: apply changes to a replica, stateful
latest-row-per-key, windowed change rates; plus start/await helpers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.fold import ORDER
from tidemark.streaming.change_table import ChangeTable, writer_id


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_apply(stream: DataFrame, table: ChangeTable, checkpoint: str, *,
                to_changes: Callable[[DataFrame], DataFrame] | None = None,
                quarantine_path: str | None = None, trigger: str | None = "5 seconds",
                name: str | None = None) -> StreamingQuery:
    """``foreachBatch`` apply: each micro-batch is (optionally) parsed once, its bad
    rows go to quarantine and the rest, one change per key, to the table.

    ``to_changes(batch)`` returns typed rows with a ``_reason`` (null: valid); the parsed batch
    is kept while both parts are written. An object with ``epoch(batch, epoch, writer)`` (a context manager) may also
    write what goes with the batch. All writes replace the
    folder of their (writer, epoch), so a retried batch leaves nothing twice.
    """
    writer = writer_id(checkpoint)

    @contextmanager
    def parsed_rows(batch: DataFrame, epoch: int) -> Iterator[DataFrame]:
        if hasattr(to_changes, "epoch"):
            with to_changes.epoch(batch, epoch, writer) as rows:
                yield rows
            return
        rows = (batch if to_changes is None else to_changes(batch)).persist()
        try:
            yield rows
        finally:
            rows.unpersist()

    def write_batch(batch: DataFrame, epoch: int) -> None:
        with parsed_rows(batch, epoch) as rows:
            if to_changes is not None and quarantine_path is not None:
                rows.filter(F.col("_reason").isNotNull()).write.mode("overwrite").parquet(f"{quarantine_path}/writer={writer}/epoch={epoch}")
            table.apply(rows if to_changes is None else rows.filter(F.col("_reason").isNull()), epoch, writer=writer)

    w = stream.writeStream.foreachBatch(write_batch).outputMode("update").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def _start_stateful(agg: DataFrame, table: ChangeTable, checkpoint: str, trigger: str | None, generation: int | None = None) -> StreamingQuery:
    """Write what each trigger of a stateful aggregation changed."""
    def write_batch(batch: DataFrame, epoch: int) -> None:
        if generation is not None:
            batch = batch.withColumns({"generation": F.lit(generation), "epoch_id": F.lit(epoch).cast("long")})
        table.apply(batch, epoch, writer=writer_id(checkpoint))

    w = agg.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def stream_latest(stream: DataFrame, key: str, order: Sequence[str] = ORDER) -> DataFrame:
    """Stateful latest row per key: streaming ``groupBy(key).agg(max_by)``.
    State holds one row per key (use the RocksDB state store provider for large
    key sets: ``spark.sql.streaming.stateStore.providerClass``)."""
    cols = [c for c in stream.columns]
    return (stream.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order])).alias("_r"))
            .select("_r.*"))


def start_latest(stream: DataFrame, key: str, table: ChangeTable, checkpoint: str, *,
                 order: Sequence[str] = ORDER, trigger: str | None = "5 seconds") -> StreamingQuery:
    """Stateful latest-row stream in ``update`` mode: each trigger writes only the
    keys whose latest row changed."""
    return _start_stateful(stream_latest(stream, key, order), table, checkpoint, trigger)


def stored_state(spark: SparkSession, checkpoint: str, cols: Sequence[str], operator: int = 0) -> DataFrame:
    """What ``start_latest`` keeps in its state store, as of the last committed micro-batch: its latest row per key, read
    with Spark's state source so that it can be held against the log or the replica (``analytics.reconcile``)."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("value.valueWithExtremumOrdering.*").select(*cols)


def stream_rate(stream: DataFrame, window: str, slide: str | None = None, watermark: str = "10 minutes",
                by: Sequence[str] = (), ts: str = "ts_ms") -> DataFrame:
    """Windowed change counts with a watermark bounding state and lateness."""
    s = stream.withColumn("_event_time", F.timestamp_millis(F.col(ts))).withWatermark("_event_time", watermark)
    w = F.window("_event_time", window, slide) if slide else F.window("_event_time", window)
    return (s.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n_changes"))
            .select(F.unix_millis(F.col("w.start")).alias("window_start_ms"), *by, "n_changes"))


RATE_ORDER = ("generation", "epoch_id")


def start_rate(stream: DataFrame, table: ChangeTable, checkpoint: str, window: str, *, slide: str | None = None,
               watermark: str = "10 minutes", by: Sequence[str] = (), ts: str = "ts_ms",
               trigger: str | None = "5 seconds", generation: int = 0) -> StreamingQuery:
    """Windowed change counts in ``update`` mode: the watermark lets Spark drop
    the state of closed windows, and every trigger writes the changed window
    counts, keyed by ``(window_start_ms, *by)``. The table's order is ``RATE_ORDER``: the newest epoch of
    the newest generation holds a window's count. After a lost checkpoint pass a higher ``generation``:
    its counts replace the old ones window by window."""
    agg = stream_rate(stream, window, slide, watermark, by, ts).withColumn("op", F.lit("u"))
    return _start_stateful(agg, table, checkpoint, trigger, generation)


def await_all(spark: SparkSession, queries: dict[str, StreamingQuery] | Sequence[StreamingQuery],
              timeout: float | None = None, poll_s: float = 1.0) -> None:
    """Wait on ALL queries: the first failure anywhere stops the rest and is
    raised (waiting on the first query alone would hide later failures)."""
    qs = list(queries.values()) if isinstance(queries, dict) else list(queries)
    start = time.monotonic()
    try:
        while True:
            for q in qs:
                if q.exception() is not None:
                    q.awaitTermination()          # re-raises the query's failure
            if not any(q.isActive for q in qs):
                return
            if timeout is not None and time.monotonic() - start > timeout:
                return
            for q in qs:
                if q.isActive:
                    q.awaitTermination(poll_s)    # raises if it fails meanwhile
    finally:
        for q in qs:
            if q.isActive:
                q.stop()
