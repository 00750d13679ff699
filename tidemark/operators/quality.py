"""Data-quality rules. Each returns one row per violation with the common
schema ``rule, tbl, col, key, detail`` so rules can be unioned and summarised.
All are filters or single aggregations (partial + final), no collect."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import OP_DOMAIN, TableSpec


def _key_str(key: str | Sequence[str]) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def _v(df: DataFrame, rule: str, tbl: str, col: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(tbl).alias("tbl"), F.lit(col).alias("col"),
                     key.alias("key"), detail.cast("string").alias("detail"))


def dq_pk(df: DataFrame, key: str | Sequence[str], tbl: str) -> DataFrame:
    """Primary key uniqueness and presence: keys occurring more than once, and keys that are (or hold) NULL, with their number of rows."""
    keys = [key] if isinstance(key, str) else list(key)
    absent = F.lit(False)
    for k in keys:
        absent = absent | F.col(k).isNull()
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | absent)
    return _v(dup, "pk_unique", tbl, ",".join(keys), _key_str(keys), F.col("_n"))


def dq_unique(df: DataFrame, col: str, tbl: str) -> DataFrame:
    """UNIQUE column: values occurring more than once (NULLs are not duplicates)."""
    dup = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return _v(dup, "unique", tbl, col, F.col(col).cast("string"), F.col("_n"))


@dataclass(frozen=True)
class Check:
    """A row-level rule: ``bad`` is true on violating rows, ``detail`` is reported."""
    rule: str
    col: str
    bad: Column
    detail: Column


def not_null(col: str) -> Check:
    return Check("not_null", col, F.col(col).isNull(), F.lit(None).cast("string"))


def max_length(col: str, n: int) -> Check:
    return Check("length", col, F.length(F.col(col)) > n, F.length(F.col(col)))


def in_domain(col: str, values: Sequence) -> Check:
    return Check("domain", col, F.col(col).isNotNull() & ~F.col(col).isin(list(values)), F.col(col))


def in_range(col: str, lo=None, hi=None, lo_inclusive: bool = True) -> Check:
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | ((c < F.lit(lo)) if lo_inclusive else (c <= F.lit(lo)))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return Check("range", col, c.isNotNull() & cond, c)


def matches(col: str, regex: str) -> Check:
    return Check("shape", col, F.col(col).isNotNull() & ~F.col(col).rlike(regex), F.col(col))


def check_rows(df: DataFrame, tbl: str, key: str | Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """Evaluate every row-level check in ONE pass over ``df``: each row yields
    an array of its violations (NULLs compacted away), exploded to one row per
    violation. N rules cost one scan, not N."""
    found = F.array(*[F.when(c.bad, F.struct(F.lit(c.rule).alias("rule"), F.lit(c.col).alias("col"),
                                             c.detail.cast("string").alias("detail")))
                      for c in checks])
    return (df.select(_key_str(key).alias("key"), F.explode(F.array_compact(found)).alias("_v"))
            .select(F.col("_v.rule").alias("rule"), F.lit(tbl).alias("tbl"), F.col("_v.col").alias("col"),
                    "key", F.col("_v.detail").alias("detail")))


def spec_checks(spec: TableSpec) -> list[Check]:
    """The row-level rules that a table's spec declares: NOT NULL columns and VARCHAR lengths."""
    return [*[not_null(c) for c in spec.not_null], *[max_length(c, n) for c, n in spec.lengths.items()]]


def check_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every violation of a table's spec: its row-level rules in one scan, its primary key and each UNIQUE column in one aggregate each."""
    keyed = [dq_pk(df, spec.key, spec.name), *([dq_pk(df, spec.pk, spec.name)] if spec.two_keys else [])]
    checks = spec_checks(spec)
    rows = [check_rows(df, spec.name, spec.key, checks)] if checks else []
    return _union([*rows, *keyed, *[dq_unique(df, c, spec.name) for c in spec.unique if c != spec.key]])


def dq_not_null(df: DataFrame, cols: Sequence[str], key: str, tbl: str) -> DataFrame:
    """NOT NULL: one violation per (row, column)."""
    return check_rows(df, tbl, key, [not_null(c) for c in cols])


def dq_length(df: DataFrame, limits: dict[str, int], key: str, tbl: str) -> DataFrame:
    """VARCHAR(n): values longer than n characters."""
    return check_rows(df, tbl, key, [max_length(c, n) for c, n in limits.items()])


def dq_domain(df: DataFrame, col: str, values: Sequence, key: str, tbl: str) -> DataFrame:
    """Value outside an allowed set (NULL is not checked here, see NOT NULL)."""
    return check_rows(df, tbl, key, [in_domain(col, values)])


def dq_range(df: DataFrame, col: str, key: str, tbl: str, lo=None, hi=None, lo_inclusive: bool = True) -> DataFrame:
    """Numeric range (e.g. stock >= 0, price > 0)."""
    return check_rows(df, tbl, key, [in_range(col, lo, hi, lo_inclusive)])


def dq_shape(df: DataFrame, col: str, regex: str, key: str, tbl: str) -> DataFrame:
    """Value not matching a pattern (key shape, phone format, SKU prefix)."""
    return check_rows(df, tbl, key, [matches(col, regex)])


def dq_images(parsed: DataFrame, spec: TableSpec) -> DataFrame:
    """Envelope completeness: inserts carry every column in ``after``, updates
    carry both images, deletes carry the key (or the pk) in ``before``, op in domain."""
    cols = spec.names
    has_all = F.lit(True)
    for c in cols:
        has_all = has_all & F.coalesce(F.map_contains_key(F.col("after"), F.lit(c)), F.lit(False))
    key_in_before = (F.coalesce(F.map_contains_key(F.col("before"), F.lit(spec.key)), F.lit(False))
                     | F.coalesce(F.map_contains_key(F.col("before"), F.lit(spec.pk_col)), F.lit(False)))
    op = F.col("op")
    detail = (F.when(op.isNull() | ~op.isin(*OP_DOMAIN), F.lit("op_domain"))
              .when(op.isin("c", "r") & ~has_all, F.lit("insert_missing_columns"))
              .when((op == "u") & (F.col("before").isNull() | F.col("after").isNull()), F.lit("update_missing_image"))
              .when((op == "d") & ~key_in_before, F.lit("delete_without_key")))
    key = F.coalesce(F.col("key"), F.lit("NULL")) if "key" in parsed.columns else F.lit(None).cast("string")
    bad = parsed.withColumn("_d", detail).filter(F.col("_d").isNotNull())
    return _v(bad, "images", spec.name, "op", key, F.col("_d"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_summary(violations: Sequence[DataFrame]) -> DataFrame:
    """Violations per (rule, table, column)."""
    return (_union(list(violations)).groupBy("rule", "tbl", "col")
            .agg(F.count(F.lit(1)).alias("violations")))
