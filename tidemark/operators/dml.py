"""DML as set-based transformations that yield the next table state.

Plain Parquet tables have no row-level UPDATE/DELETE/MERGE, so each statement
is a DataFrame -> DataFrame function; writing the result as a new version is
the commit. All are narrow except the joins, which shuffle on the key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The instant of a statement: ``NOW`` at run time, or a given one. Without one no row is stamped.
NOW = F.current_timestamp
Instant = Column | dt.datetime | None


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def update_where(df: DataFrame, cond: Column, values: dict[str, Column | object], *, now: Instant = None, now_col: str = "updated_at") -> DataFrame:
    """``UPDATE t SET c = v, ..., now_col = now WHERE cond``. All values are those of the rows before the update."""
    if now is not None:
        values = {**values, now_col: now}
    of = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.when(cond, _lit(values[c])).otherwise(F.col(c)).cast(t).alias(c) if c in values else F.col(c) for c, t in of.items()])


def update_by_key(df: DataFrame, key: str, k, values: dict[str, Column | object], **stamp) -> DataFrame:
    """``UPDATE t SET ... WHERE key = k``; ``now`` and ``now_col`` as in ``update_where``."""
    return update_where(df, F.col(key) == F.lit(k), values, **stamp)


def guarded_update(df: DataFrame, guard: Column, values: dict[str, Column | object], **stamp) -> DataFrame:
    """Update only rows that pass the guard (e.g. ``status != 'delivered'``); ``now`` and ``now_col`` as in ``update_where``."""
    return update_where(df, guard, values, **stamp)


def conditional_update(df: DataFrame, key: str, counts: DataFrame, count_col: str, threshold: int,
                       values: dict[str, Column | object], **stamp) -> DataFrame:
    """``UPDATE t SET ... WHERE <per-key aggregate> > threshold``: the aggregate
    is computed once, joined on the key, and drives the update."""
    j = df.join(counts.select(key, count_col), key, "left").withColumn(
        count_col, F.coalesce(F.col(count_col), F.lit(0)))
    return update_where(j, F.col(count_col) > F.lit(threshold), values, **stamp)


def insert_rows(df: DataFrame, new_rows: DataFrame, *, now: Instant = None, now_cols: Sequence[str] = ("created_at", "updated_at")) -> DataFrame:
    """``INSERT INTO t VALUES ...`` (by column name; missing columns NULL). With ``now``, the new rows' ``now_cols``
    that ``df`` has and the rows leave open hold that instant."""
    if now is not None:
        for c in now_cols:
            if c in df.columns:
                given = F.col(c) if c in new_rows.columns else F.lit(None)
                new_rows = new_rows.withColumn(c, F.coalesce(given, _lit(now)).cast(df.schema[c].dataType))
    return df.unionByName(new_rows.select(*[c for c in new_rows.columns if c in df.columns]),
                          allowMissingColumns=True)


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column DEFAULTs on insert: NULL -> the default literal or column (e.g. ``NOW()``)."""
    out = df
    for c, v in defaults.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), _lit(v).cast(out.schema[c].dataType)))
    return out


def cascade_delete(parent: DataFrame, child: DataFrame, parent_key: str, child_fk: str,
                   doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete children, then parents, for the parent keys in ``doomed``.
    Returns (parent_after, child_after)."""
    keys = doomed.select(F.col(parent_key)).filter(F.col(parent_key).isNotNull())
    child_after = child.join(keys.withColumnRenamed(parent_key, child_fk), child_fk, "left_anti")
    parent_after = parent.join(keys, parent_key, "left_anti")
    return parent_after, child_after


def increment_totals(orders: DataFrame, order_key: str, total_col: str, deltas: DataFrame,
                     delta_col: str) -> DataFrame:
    """``UPDATE orders SET total = total + delta``: deltas are pre-aggregated per
    key (partial aggregation, so many items of one order shuffle as one row)."""
    d = deltas.groupBy(order_key).agg(F.sum(delta_col).alias("_delta"))
    t = orders.schema[total_col].dataType
    return (orders.join(d, order_key, "left")
            .withColumn(total_col, (F.col(total_col).cast(t) + F.coalesce(F.col("_delta"), F.lit(0)).cast(t)).cast(t))
            .drop("_delta"))
