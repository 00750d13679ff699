"""Pipeline monitoring as data jobs: change rates, delivery lag, consumer lag
and SLA checks, computed from the change log itself."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def change_rate(log: DataFrame, window_ms: int, by: Sequence[str] = (), ts: str = "ts_ms") -> DataFrame:
    """Tumbling-window change counts and events/second per window (and per ``by``).
    Window starts are epoch-aligned epoch milliseconds (time-zone free)."""
    start = (F.floor(F.col(ts) / F.lit(window_ms)) * F.lit(window_ms)).cast("long")
    return (log.groupBy(start.alias("window_start_ms"), *by)
            .agg(F.count(F.lit(1)).alias("n_changes"))
            .withColumn("per_second", F.round(F.col("n_changes") / F.lit(window_ms / 1000.0), 6)))


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def _seconds(interval: str) -> int | None:
    found = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", interval)
    return int(found[1]) * _UNITS[found[2]] if found else None


def sliding_rate(log: DataFrame, window: str, slide: str, by: Sequence[str] = (), ts: str = "ts_ms") -> DataFrame:
    """Sliding-window counts. Changes are counted once per slide step, and the counts are spread over the windows that
    hold the step, so rows aren't multiplied by window/slide. (Steps that don't divide the window: every change is spread.)"""
    t, n = F.timestamp_millis(F.col(ts)), F.count(F.lit(1))
    whole, step = _seconds(window), _seconds(slide)
    counted = log
    if whole and step and whole % step == 0:
        counted = (log.groupBy(F.window(t, slide).alias("_step"), *by).agg(n.alias("_n"))
                   .select(F.col("_step.start").alias("_t"), *by, "_n"))
        t, n = F.col("_t"), F.sum("_n")
    return (counted.groupBy(F.window(t, window, slide).alias("w"), *by).agg(n.alias("n_changes"))
            .select(F.unix_millis(F.col("w.start")).alias("window_start_ms"),
                    F.unix_millis(F.col("w.end")).alias("window_end_ms"), *by, "n_changes"))


def replication_lag(log_with_commit: DataFrame, by: Sequence[str] = (), ts: str = "ts_ms",
                    committed: str = "committed_at_ms", sla_ms: int = 60_000, approx_pct: bool = False) -> DataFrame:
    """Delivery lag per change = commit time - event time, summarised per ``by``.
    Exact, distributive aggregates only (count/avg/max/over-SLA); the optional
    p95 uses ``percentile_approx`` so no group is ever collected whole."""
    lag = (F.col(committed) - F.col(ts))
    aggs = [F.count(F.lit(1)).alias("n_changes"), F.round(F.avg(lag), 3).alias("avg_lag_ms"),
            F.max(lag).alias("max_lag_ms"), F.count(F.when(lag > F.lit(sla_ms), 1)).alias("over_sla")]
    if approx_pct:
        aggs.append(F.percentile_approx(lag, 0.95, 10_000).alias("p95_lag_ms_approx"))
    return log_with_commit.groupBy(*by).agg(*aggs)


#: Bins of the first pass of exact percentiles.
BINS = 4096


def exact_percentiles(df: DataFrame, value: str, by: Sequence[str], percents: Sequence[int] = (50, 95, 99)) -> DataFrame:
    """Exact percentiles (the value at rank ceil(n * p / 100), NULLs left out) of a whole-number column per ``by``,
    one row per group with columns ``p<percent>``.

    Two passes, each a grouped count with its partial phase before the shuffle: counts in ``BINS`` equal bins of the
    column's range tell the bin that holds each rank, and counts of the single values of those bins alone tell the value. No group's
    rows come together. NULL groups are groups.
    """
    known = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("long").alias("_v"))
    low, high = (known.agg(f("_v")).scalar() for f in (F.min, F.max))
    width = F.greatest(F.lit(1), F.ceil((high - low + 1) / F.lit(BINS)))
    binned = known.withColumn("_bin", F.floor((F.col("_v") - low) / width).cast("long"))
    upto = lambda c: F.sum(c).over(Window.partitionBy(*by, *(["_bin"] if c == "_m" else [])).orderBy("_v" if c == "_m" else "_bin"))
    counts = binned.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    ranked = counts.withColumn("_upto", upto("_n")).withColumn("_all", F.sum("_n").over(Window.partitionBy(*by)))
    rank = F.greatest(F.lit(1), F.floor((F.col("_all") * F.col("_p") + 99) / 100))
    asked = (ranked.withColumn("_p", F.explode(F.array(*[F.lit(int(p)) for p in percents]))).withColumn("_rank", rank)
             .filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n")))
             .select(*by, "_bin", "_p", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank")))
    same = lambda a, b, cols: reduce(and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])
    bins = asked.select(*by, "_bin").distinct()
    singles = (binned.alias("a").join(bins.alias("b"), same("a", "b", [*by, "_bin"]), "left_semi")
               .groupBy(*by, "_bin", "_v").agg(F.count(F.lit(1)).alias("_m")).withColumn("_upto", upto("_m")))
    hit = (singles.alias("s").join(asked.alias("q"), same("s", "q", [*by, "_bin"]) & (F.col("q._rank") <= F.col("s._upto")) & (F.col("q._rank") > F.col("s._upto") - F.col("s._m")))
           .select(*[F.col(f"s.{c}").alias(c) for c in by], "q._p", "s._v"))
    return hit.groupBy(*by).agg(*[F.max(F.when(F.col("_p") == p, F.col("_v"))).alias(f"p{p}") for p in percents])


def consumer_lag(log: DataFrame, committed: DataFrame, *, topic: str = "topic", partition: str = "partition",
                 offset: str = "offset") -> DataFrame:
    """Per topic partition: end offset, last committed offset and the number of
    records after it. ``committed``: a consumer's positions (topic, partition, committed_offset);
    a partition without one has everything pending."""
    j = log.join(committed.select(topic, partition, "committed_offset"), [topic, partition], "left")
    pending = F.col("committed_offset").isNull() | (F.col(offset) > F.col("committed_offset"))
    return (j.groupBy(topic, partition)
            .agg(F.max(offset).alias("end_offset"), F.max("committed_offset").alias("committed_offset"),
                 F.count(F.when(pending, 1)).alias("lag_messages")))


LIMITS_SCHEMA = T.StructType([T.StructField("metric", T.StringType(), False),
                              T.StructField("limit_value", T.DoubleType(), False)])

# Fixed SLA thresholds of the monitored pipeline: consumer lag < 10,000
# messages, micro-batch duration < 30 s, end-to-end delivery < 60 s.
DEFAULT_LIMITS = [("consumer_lag_messages", 10_000.0), ("batch_duration_s", 30.0), ("end_to_end_lag_s", 60.0)]


def limits_frame(spark: SparkSession, limits=None) -> DataFrame:
    return spark.createDataFrame(limits or DEFAULT_LIMITS, LIMITS_SCHEMA)


def sla_breaches(metrics: DataFrame, limits: DataFrame, only_breaches: bool = True) -> DataFrame:
    """``metrics(metric, subject, value)`` joined to ``limits(metric, limit_value)``; flags values above their limit."""
    j = metrics.join(limits, "metric", "inner").withColumn(
        "breach", F.col("value") > F.col("limit_value"))
    return j.filter(F.col("breach")) if only_breaches else j


def progress_frame(spark: SparkSession, query) -> DataFrame:
    """A streaming query's progress reports as a DataFrame, bounded by
    ``spark.sql.streaming.numRecentProgressUpdates``; raises once Spark may have dropped older ones."""
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(query.recentProgress) >= kept:
        raise ValueError(f"{kept} reports are kept: raise spark.sql.streaming.numRecentProgressUpdates for this query")
    rows = [(p.get("batchId"), p.get("numInputRows"), p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"),
             (p.get("durationMs") or {}).get("triggerExecution"))
            for p in (pp if isinstance(pp, dict) else pp.jsonValue() if hasattr(pp, "jsonValue") else dict(pp)
                      for pp in query.recentProgress)]
    schema = "batch_id long, num_input_rows long, input_rows_per_second double, processed_rows_per_second double, trigger_ms long"
    return spark.createDataFrame(rows, schema)
