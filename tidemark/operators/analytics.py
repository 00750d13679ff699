"""Analytic operators over replica tables: joins, counts, top-n, reconciliation.

No join strategy is forced: with AQE on, Spark broadcasts a side only after
measuring it at runtime (``spark.sql.adaptive.autoBroadcastJoinThreshold``)
and otherwise shuffles both sides on the key; skewed partitions are split by
AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, col: str, alias: str = "total") -> DataFrame:
    """``SELECT col, COUNT(*) FROM t GROUP BY col`` (partial + final aggregate)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(alias))


def kpi_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``COUNT(*)`` per table, unioned with a table label."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def change_audit(log: DataFrame, table_col: str = "table", ts: str = "ts_ms") -> DataFrame:
    """Per table: change count and first/last event time."""
    return (log.groupBy(table_col)
            .agg(F.count(F.lit(1)).alias("change_count"), F.min(ts).alias("first_event"),
                 F.max(ts).alias("last_event")))


def changes_by_op(log: DataFrame, table_col: str = "table", op: str = "op") -> DataFrame:
    return log.groupBy(table_col, op).agg(F.count(F.lit(1)).alias("n_changes"))


def top_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """``ORDER BY ... LIMIT n``: planned as a distributed top-k
    (``TakeOrderedAndProject``): each task keeps n rows, the driver merges."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Deterministic stand-in for ``ORDER BY RANDOM() LIMIT n``: rank rows by a
    seeded hash of the key (md5, so any engine reproduces it) and take n."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def first_match(df: DataFrame, cond: Column, key: str) -> DataFrame:
    """``WHERE cond LIMIT 1`` made deterministic: the smallest key that matches."""
    return df.filter(cond).orderBy(key).limit(1)


def reconcile(source: DataFrame, replica: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Source vs replica, per key: ``missing`` (in source only), ``extra`` (in
    replica only), ``differs`` (NULL-safe difference in any column), ``same``."""
    s = source.select(key, *[F.col(c).alias(f"src_{c}") for c in cols]).withColumn("_s", F.lit(True))
    r = replica.select(key, *[F.col(c).alias(f"rep_{c}") for c in cols]).withColumn("_r", F.lit(True))
    j = s.join(r, key, "full")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"src_{c}").eqNullSafe(F.col(f"rep_{c}"))
    status = (F.when(F.col("_r").isNull(), "missing").when(F.col("_s").isNull(), "extra")
              .when(same, "same").otherwise("differs"))
    return j.select(key, status.alias("status"), *[f"src_{c}" for c in cols], *[f"rep_{c}" for c in cols])


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose foreign key has no parent (left anti join; NULL FKs are
    not orphans, as in SQL)."""
    return child.filter(F.col(fk).isNotNull()).join(
        parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def enrich(log: DataFrame, dim: DataFrame, log_key: str, dim_key: str, cols: Sequence[str]) -> DataFrame:
    """Left join of changes to a dimension (works for a streaming log against a
    static dimension too)."""
    d = dim.select(F.col(dim_key).alias(log_key), *cols)
    return log.join(d, log_key, "left")


def order_totals(items: DataFrame, order_key: str, qty: str, price: str, scale: str = "decimal(12,2)") -> DataFrame:
    """Order total from its items: ``sum(qty * price)`` in exact decimals."""
    return (items.groupBy(order_key)
            .agg(F.sum(F.col(qty).cast(scale) * F.col(price).cast(scale)).cast("decimal(20,2)").alias("items_total"),
                 F.count(F.lit(1)).alias("n_items")))
