"""The change log derived from the provided ``events`` table, and its SQL twin.

Mapping (fixed so that Spark and the SQL oracle build the identical log):

* key ``k`` = ``user_id``
* op: ``signup`` -> ``c`` (insert), ``error`` -> ``d`` (delete), anything else -> ``u``
* row image: ``status`` = ``event_type``, ``amount`` = ``value`` as ``decimal(12,2)``
* ``ts_ms`` = event time in epoch milliseconds (time-zone free), ``pos`` = ``event_id``
* ``batch_id`` = ``event_id DIV 100`` (the micro-batch / commit the change landed in)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import ms_from_ntz
from tidemark.sources.tables import read_table

BATCH_SIZE = 100


def event_log(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = (), *,
              upto_batch: int | None = None, after_batch: int | None = None,
              upto_ts_ms: int | None = None) -> DataFrame:
    """The derived typed change log; ``extra`` raw event columns ride along
    from the same scan (no self-join). ``upto_batch`` restricts the scan to
    commits ``<= upto_batch`` with a filter on the stored ``event_id`` column,
    which reaches Parquet (row-group skipping), unlike a filter on the derived
    ``batch_id``. ``after_batch`` likewise keeps commits ``> after_batch``, and
    ``upto_ts_ms`` keeps events with ``ts_ms <= upto_ts_ms`` through the stored
    ``ts`` column."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", *extra])
    if upto_batch is not None:
        ev = ev.filter(F.col("event_id") < F.lit((upto_batch + 1) * BATCH_SIZE))
    if after_batch is not None:
        ev = ev.filter(F.col("event_id") >= F.lit((after_batch + 1) * BATCH_SIZE))
    if upto_ts_ms is not None:
        # ts_ms <= T  <=>  ts < epoch + (T + 1) ms   (ts_ms floors sub-millisecond parts)
        bound = _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=upto_ts_ms + 1)
        ev = ev.filter(F.col("ts") < F.expr(f"TIMESTAMP_NTZ'{bound.isoformat(sep=' ')}'"))
    return ev.select(
        F.col("user_id").alias("k"),
        F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d")
        .otherwise("u").alias("op"),
        F.col("event_type").alias("status"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        ms_from_ntz(F.col("ts")).alias("ts_ms"),
        F.col("event_id").alias("pos"),
        F.floor(F.col("event_id") / BATCH_SIZE).cast("long").alias("batch_id"),
        *[F.col(c) for c in extra],
    )


def commit_at(spark: SparkSession, sf_dir: str, share: int) -> int:
    """The commit at ``share`` hundredths of the log, whatever its size (one aggregate of one column)."""
    newest = read_table(spark, sf_dir, "events", ["event_id"]).agg(F.max("event_id")).first()[0]
    return (newest or 0) // BATCH_SIZE * share // 100


def commit_sql(share: int) -> str:
    """``commit_at`` as a scalar subquery of the oracles."""
    return f"(SELECT max(event_id) // {BATCH_SIZE} * {share} // 100 FROM events)"


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    return read_table(spark, sf_dir, name, columns)


# SQL twin used by the oracles (DuckDB dialect).
LOG_SQL = (
    "SELECT user_id AS k, "
    "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, "
    "event_type AS status, CAST(value AS DECIMAL(12,2)) AS amount, "
    "epoch_us(ts) // 1000 AS ts_ms, event_id AS pos, event_id // 100 AS batch_id FROM events"
)


def with_log(body: str, extra: str = "") -> str:
    """Prefix an oracle body with the ``log`` CTE (and optional extra CTEs)."""
    return f"WITH log AS ({LOG_SQL}){(', ' + extra) if extra else ''} {body}"
