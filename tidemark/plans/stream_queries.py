"""Streaming queries. Each writes the derived
change log as several files into a fresh folder under the shared checkpoint
folder, runs a Structured Streaming query over them to completion
(``availableNow``), and returns the result read back from storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.analytics import reconcile
from tidemark.operators.fold import latest_state
from tidemark.plans.core_queries import LATEST_SQL, STATE_COLS
from tidemark.plans.registry import register
from tidemark.plans.testdata import event_log, with_log
from tidemark.session import work_dir
from tidemark.streaming.apply import RATE_ORDER, start_apply, start_latest, start_rate, stored_state
from tidemark.streaming.change_table import ChangeTable
from tidemark.streaming.progress import ProgressLog
from tidemark.streaming.rates import RateTable, stream_sliding_rate

LANDINGS = 4                  # deliveries of the log, one micro-batch each
LATE_MS = 86_400_000          # how late a change may come

LOG_COLS = ["k", "op", "status", "amount", "ts_ms", "pos", "batch_id"]


def stage_log_files(spark, sf, root: str) -> tuple[str, DataFrame]:
    """Write the log as files that each hold a contiguous range of positions
    (the order a capture connector would have produced them); their number follows the shuffle setting."""
    path = f"{root}/incoming"
    event_log(spark, sf).repartitionByRange("pos").write.mode("overwrite").parquet(path)
    return path, spark.read.parquet(path)


def _stream(spark, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def _run_apply(spark, sf, max_files: int | None) -> tuple[ChangeTable, object]:
    root = work_dir(spark, "stream-apply")
    path, static = stage_log_files(spark, sf, root)
    table = ChangeTable(spark, f"{root}/replica", "k", static.select(*STATE_COLS).schema)
    q = start_apply(_stream(spark, path, static.schema, max_files).select(*STATE_COLS), table,
                    f"{root}/_checkpoint", trigger="availableNow", name=None)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return table, q


@register("stream_upsert", LATEST_SQL)
def q_stream_upsert(spark, sf):
    """``foreachBatch`` apply: one folder of folded changes per micro-batch."""
    table, _ = _run_apply(spark, sf, None)
    return table.read().select(*STATE_COLS)


@register("stream_rate_limited", LATEST_SQL)
def q_stream_rate_limited(spark, sf):
    """Same apply with admission control (one file per trigger); the final state is unchanged."""
    table, _ = _run_apply(spark, sf, 1)
    return table.read().select(*STATE_COLS)


@register("stream_latest", LATEST_SQL)
def q_stream_latest(spark, sf):
    """Stateful streaming aggregation (latest row per key) in update mode,
    written as changes."""
    root = work_dir(spark, "stream-latest")
    path, static = stage_log_files(spark, sf, root)
    table = ChangeTable(spark, f"{root}/replica", "k", static.select(*STATE_COLS).schema)
    q = start_latest(_stream(spark, path, static.schema).select(*STATE_COLS), "k", table,
                     f"{root}/_checkpoint", trigger="availableNow")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return table.read().select(*STATE_COLS)


@register("stream_rate", with_log(
    "SELECT (ts_ms // 60000) * 60000 AS window_start_ms, status, count(*) AS n_changes FROM log GROUP BY 1, status"))
def q_stream_rate(spark, sf):
    """Windowed change counts per minute: update mode with a watermark (closed
    windows leave the state store), the newest count of each window."""
    root = work_dir(spark, "stream-rate")
    path, static = stage_log_files(spark, sf, root)
    schema = T.StructType([T.StructField("window_start_ms", T.LongType()), T.StructField("status", T.StringType()),
                           T.StructField("n_changes", T.LongType()), T.StructField("op", T.StringType()),
                           T.StructField("generation", T.IntegerType()), T.StructField("epoch_id", T.LongType())])
    table = ChangeTable(spark, f"{root}/rates", ["window_start_ms", "status"], schema, order=RATE_ORDER)
    q = start_rate(_stream(spark, path, static.schema), table, f"{root}/_checkpoint", "1 minute",
                   watermark="1 hour", by=["status"], trigger="availableNow")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return table.read().select("window_start_ms", "status", "n_changes")


@register("append_log", with_log("SELECT k, op, status, amount, ts_ms, pos, batch_id FROM log"))
def q_append_log(spark, sf):
    """The change log kept as an append-only table (append sink)."""
    root = work_dir(spark, "append-log")
    path, static = stage_log_files(spark, sf, root)
    target = f"{root}/log_table"
    q = (_stream(spark, path, static.schema).writeStream.format("parquet").outputMode("append")
         .option("path", target).option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(target).select(*LOG_COLS)


@register("data_files")
def q_data_files(spark, sf):
    """Data files behind the replica's state (``$files``): path, size, rows."""
    table, _ = _run_apply(spark, sf, None)
    return table.files()


@register("data_files_total", with_log("SELECT count(DISTINCT k) AS record_count, true AS sized FROM log"))
def q_data_files_total(spark, sf):
    """The data files together hold each key of the one micro-batch once, and every file has a size."""
    table, _ = _run_apply(spark, sf, None)
    return table.files().agg(F.sum("record_count").alias("record_count"), (F.min("file_size") > 0).alias("sized"))


@register("snapshot_size_trend")
def q_snapshot_size_trend(spark, sf):
    """Rows, files and bytes written per micro-batch of the replica
    (size trend), after an admission-controlled apply."""
    table, _ = _run_apply(spark, sf, 1)
    return table.size_trend().select("version", "files", "rows", "bytes")


def landed_log(spark, sf) -> DataFrame:
    """The log in ``LANDINGS`` deliveries by commit, of which every tenth change comes one delivery late."""
    log = event_log(spark, sf)
    span = F.floor(F.col("batch_id") * LANDINGS / (log.agg(F.max("batch_id")).scalar() + 1))
    return log.withColumn("landing", F.least(F.lit(LANDINGS - 1), span + F.when(F.col("pos") % 10 == 3, 1).otherwise(0)).cast("long"))


_LANDED = (f"landed AS (SELECT *, least({LANDINGS - 1}, batch_id * {LANDINGS} // ((SELECT max(batch_id) FROM log) + 1) + CASE WHEN pos % 10 = 3 THEN 1 ELSE 0 END) AS landing FROM log), "
           f"marks AS (SELECT a.landing, max(b.ts_ms) - {LATE_MS} AS watermark_ms FROM (SELECT DISTINCT landing FROM landed) a LEFT JOIN landed b ON b.landing < a.landing GROUP BY a.landing)")


def _run_landings(spark, sf, name: str, start) -> str:
    """Land one delivery after the other and run the stream ``start(stream, root)`` over each to completion, from the same checkpoint."""
    root = work_dir(spark, name)
    log = landed_log(spark, sf)
    schema = log.select(*LOG_COLS).schema
    for n in range(LANDINGS):
        log.filter(F.col("landing") == n).select(*LOG_COLS).write.mode("append").parquet(f"{root}/incoming")
        q = start(_stream(spark, f"{root}/incoming", schema), root)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return root


def _rates(spark, root: str) -> RateTable:
    return RateTable(spark, f"{root}/rates", window_ms=60_000, delay_ms=LATE_MS, by=["status"])


@register("late_events", with_log(
    "SELECT pos, k, ts_ms, landing AS epoch, watermark_ms FROM landed JOIN marks USING (landing) WHERE ts_ms < watermark_ms", _LANDED))
def q_late_events(spark, sf):
    """Changes that came more than a day behind the newest earlier one: kept, with the epoch and the watermark they missed."""
    root = _run_landings(spark, sf, "late-events", lambda stream, root: _rates(spark, root).start(stream, f"{root}/_checkpoint", "availableNow"))
    return _rates(spark, root).late().select("pos", "k", "ts_ms", "epoch", "watermark_ms")


@register("rate_on_time", with_log(
    "SELECT (ts_ms // 60000) * 60000 AS window_start_ms, status, count(*)::BIGINT AS n_changes FROM landed JOIN marks USING (landing) "
    "WHERE watermark_ms IS NULL OR ts_ms >= watermark_ms GROUP BY 1, 2", _LANDED))
def q_rate_on_time(spark, sf):
    """Changes per minute of the same stream: every row is counted here or kept by ``late_events``."""
    root = _run_landings(spark, sf, "rate-on-time", lambda stream, root: _rates(spark, root).start(stream, f"{root}/_checkpoint", "availableNow"))
    return _rates(spark, root).counts()


@register("stream_progress", with_log("SELECT landing AS batch_id, count(*) AS num_input_rows FROM landed GROUP BY landing", _LANDED))
def q_stream_progress(spark, sf):
    """The progress reports of all micro-batches, kept across restarts of the query."""
    logs = []

    def start(stream, root):
        log = ProgressLog(spark, f"{root}/progress")
        spark.streams.addListener(log)
        q = (stream.writeStream.format("parquet").option("path", f"{root}/log_table").option("checkpointLocation", f"{root}/_checkpoint")
             .trigger(availableNow=True).start())
        try:
            q.awaitTermination()
            log.wait(q)
        finally:
            spark.streams.removeListener(log)
        logs.append(log)
        return q

    _run_landings(spark, sf, "stream-progress", start)
    return logs[-1].frame().filter("num_input_rows > 0").select("batch_id", "num_input_rows")


@register("stream_sliding_rate", with_log(
    "SELECT s AS window_start_ms, s + 300000 AS window_end_ms, count(*) AS n_changes FROM ("
    "SELECT unnest(generate_series((ts_ms // 60000) * 60000 - 240000, (ts_ms // 60000) * 60000, 60000)) AS s "
    "FROM log) GROUP BY s"))
def q_stream_sliding_rate(spark, sf):
    """5-minute windows sliding every minute, as a stream; a heartbeat a day after the last change closes the last windows."""
    root = work_dir(spark, "stream-sliding")
    path, static = stage_log_files(spark, sf, root)
    beat = static.agg((F.max("ts_ms") + 86_400_000).alias("ts_ms")).select(
        *[F.col("ts_ms") if f.name == "ts_ms" else F.lit("heartbeat") if f.name == "op" else F.lit(None).cast(f.dataType).alias(f.name) for f in static.schema.fields])
    beat = beat.toDF(*static.columns)
    for part in (None, beat):
        if part is not None:
            part.write.mode("append").parquet(path)
        rates = stream_sliding_rate(_stream(spark, path, static.schema), "5 minutes", "1 minute", watermark="1 hour", counted="op <> 'heartbeat'")
        q = (rates.writeStream.format("parquet").outputMode("append").option("path", f"{root}/rates").option("checkpointLocation", f"{root}/_checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{root}/rates")


@register("snapshot_rows_trend", with_log("SELECT landing AS version, count(DISTINCT k) AS rows FROM landed GROUP BY landing", _LANDED))
def q_snapshot_rows_trend(spark, sf):
    """Rows written per micro-batch, also of those that a compaction has merged since."""
    tables = []

    def start(stream, root):
        tables.append(ChangeTable(spark, f"{root}/replica", "k", stream.select(*STATE_COLS).schema))
        if len(tables) == LANDINGS - 1:
            tables[-1].compact()
        return start_apply(stream.select(*STATE_COLS), tables[-1], f"{root}/_checkpoint", trigger="availableNow")

    _run_landings(spark, sf, "rows-trend", start)
    return tables[-1].size_trend().select("version", "rows")


@register("state_audit", with_log(
    "SELECT coalesce(state, 'absent') AS verdict, count(*) AS n_keys FROM (SELECT 'same' AS state FROM (SELECT DISTINCT k FROM log)) GROUP BY 1"))
def q_state_audit(spark, sf):
    """The state store of the stateful latest-row query, read as a table after restarts and held against the batch fold."""
    root = _run_landings(spark, sf, "state-audit", lambda stream, root: start_latest(
        stream.select(*STATE_COLS), "k", ChangeTable(spark, f"{root}/replica", "k", stream.select(*STATE_COLS).schema), f"{root}/_checkpoint", trigger="availableNow"))
    kept = stored_state(spark, f"{root}/_checkpoint", STATE_COLS)
    want = latest_state(event_log(spark, sf).select(*STATE_COLS), "k", keep_deletes=True)
    return reconcile(want, kept, "k", [c for c in STATE_COLS if c != "k"]).groupBy(F.col("status").alias("verdict")).agg(F.count(F.lit(1)).alias("n_keys"))
