"""Per-key ordered scans (previous/next row, running sums) that survive hot keys.

A plain ``Window.partitionBy(key)`` sends every change of a key to one task; if
one key holds a third of the log, one task does a third of the work. Here every
key is cut into *chunks* by its order: the chunk of a row is the time slice
``floor(order[0] / width)``. Windows run per ``(key, chunk)`` and a
per-chunk summary carries values across chunk boundaries: the previous chunk's
last row, the next chunk's first row, and prefix totals for running sums. Only
chunks that have a neighbour get a carry. Results are exact, for NULL
values and ties as for a window over the whole key.

A time slice of a key that holds more than ``rows`` rows is cut further, by its own times or, where all are one
instant, by the second order column, into parts of about ``rows`` rows: exact counts say where, so the cut follows the data
and is the same in every part of the plan. There is one plan for all sizes: one shuffle of the log on ``(key, chunk)``; the
few slices that are cut are joined on. Rows with a NULL key have no order among themselves and are left out, as the fold does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
#: The part of a slice that is cut further.
PART = "_part"
#: Default time slice: a day of milliseconds.
WIDTH = 86_400_000
#: What one task sorts of a key at most, but for rows at one instant and position.
ROWS = 2_000_000


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def chunked(df: DataFrame, key: str | Sequence[str], order: Sequence[str], width: int = WIDTH) -> DataFrame:
    """Rows with a key, tagged with their chunk. ``order[0]`` is a number; NULLs sort first and so are the first chunk."""
    keyed = df
    for k in _keys(key):
        keyed = keyed.filter(F.col(k).isNotNull())
    return keyed.withColumn(CHUNK, F.coalesce(F.floor(F.col(order[0]) / F.lit(width)), F.lit(-(2**62))))


def parted(ch: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int | None) -> tuple[DataFrame, list[str]]:
    """Chunked rows with the part of their slice (0 in slices of at most ``rows`` rows), and the columns that name a chunk."""
    if rows is None:
        return ch, [CHUNK]
    t, p = order[0], order[min(1, len(order) - 1)]
    large = (ch.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"), F.min(t).alias("_t0"), F.max(t).alias("_t1"), F.min(p).alias("_p0"), F.max(p).alias("_p1"))
             .filter(F.col("_n") > rows))
    place = lambda c, low, high: F.floor((F.col(c) - F.col(low)) / F.greatest((F.col(high) - F.col(low)) * F.lit(float(rows)) / F.col("_n"), F.lit(1.0)))
    part = F.when(F.col("_n").isNull(), F.lit(0)).otherwise(F.coalesce(F.when(F.col("_t1") > F.col("_t0"), place(t, "_t0", "_t1")).otherwise(place(p, "_p0", "_p1")), F.lit(-1)))
    return ch.join(large, [*keys, CHUNK], "left").withColumn(PART, part.cast("long")).drop("_n", "_t0", "_t1", "_p0", "_p1"), [CHUNK, PART]


def with_neighbors(df: DataFrame, key: str | Sequence[str], order: Sequence[str], cols: Sequence[str], *,
                   prev: bool = True, nxt: bool = True, width: int = WIDTH, rows: int | None = None) -> DataFrame:
    """Add ``_prev`` / ``_next``: structs of ``order + cols`` of the previous /
    next row of the same key (NULL at the ends)."""
    keys = _keys(key)
    packed = F.struct(*[F.col(c) for c in list(order) + [c for c in cols if c not in order]])
    ch, chunk = parted(chunked(df, keys, order, width), keys, order, rows)
    w = Window.partitionBy(*keys, *chunk).orderBy(*order)
    # The summary is of the log itself, so it is combined before its (small) shuffle.
    summ = ch.groupBy(*keys, *chunk).agg(F.min(packed).alias("_first"), F.max(packed).alias("_last"))
    ws = Window.partitionBy(*keys).orderBy(*chunk)
    carry = []
    if prev:
        ch = ch.withColumn("_prev", F.lag(packed).over(w))
        carry.append(F.lag("_last").over(ws).alias("_prev_carry"))
    if nxt:
        ch = ch.withColumn("_next", F.lead(packed).over(w))
        carry.append(F.lead("_first").over(ws).alias("_next_carry"))
    summ = summ.select(*keys, *chunk, *carry)
    names = [c for c, on in (("_prev_carry", prev), ("_next_carry", nxt)) if on]
    if names:
        summ = summ.filter(" OR ".join(f"{c} IS NOT NULL" for c in names))
        ch = ch.join(summ, [*keys, *chunk], "left")
    for c in names:
        own = c.removesuffix("_carry")
        ch = ch.withColumn(own, F.coalesce(F.col(own), F.col(c))).drop(c)
    return ch.drop(*chunk)


def with_running_sum(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str, *,
                     width: int = WIDTH, rows: int | None = None) -> DataFrame:
    """Add ``_run`` (inclusive running sum of ``value`` per key, NULL until a value came) and ``_run_min``
    (running minimum of ``_run``), as a two-level parallel prefix scan."""
    keys = _keys(key)
    ch, chunk = parted(chunked(df, keys, order, width), keys, order, rows)
    w = Window.partitionBy(*keys, *chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ch = ch.withColumn("_ls", F.sum(value).over(w))
    ch = ch.withColumn("_lmin", F.min("_ls").over(w))
    summ = ch.groupBy(*keys, *chunk).agg(F.sum(value).alias("_tot"), F.min("_ls").alias("_cmin"))
    before = Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    # A total of NULL: no value came in any earlier chunk.
    summ = summ.withColumn("_off", F.sum("_tot").over(before))
    summ = summ.withColumn("_prior_min", F.min(F.coalesce("_off", F.lit(0)) + F.col("_cmin")).over(before))
    summ = summ.filter(F.col("_off").isNotNull()).select(*keys, *chunk, "_off", "_prior_min")
    out = ch.join(summ, [*keys, *chunk], "left")
    run = F.when(F.col("_off").isNotNull() | F.col("_ls").isNotNull(), F.coalesce("_off", F.lit(0)) + F.coalesce("_ls", F.lit(0)))
    return (out.withColumn("_run", run)
            .withColumn("_run_min", F.least(F.col("_prior_min"), F.coalesce("_off", F.lit(0)) + F.col("_lmin")))
            .drop(*chunk, "_ls", "_lmin", "_off", "_prior_min"))


# ---------------------------------------------------------------------------
# Operators built on the scans
# ---------------------------------------------------------------------------

def scd2(log: DataFrame, key: str, cols: Sequence[str], order: Sequence[str] = ("ts_ms", "pos"), *,
         op_col: str = "op", width: int = WIDTH, rows: int | None = ROWS) -> DataFrame:
    """SCD type-2 history: one row per version with ``valid_from`` /
    ``valid_to`` (the next change's time, NULL while current). A delete closes
    the open interval and emits no row of its own."""
    t = order[0]
    n = with_neighbors(log, key, order, [op_col, *cols], prev=False, width=width, rows=rows)
    return (n.filter(F.col(op_col) != "d")
            .select(key, *cols, F.col(t).alias("valid_from"), F.col(f"_next.{t}").alias("valid_to"),
                    F.col("_next").isNull().alias("is_current"), *[c for c in order if c != t]))


def change_delta(log: DataFrame, key: str, col: str, order: Sequence[str] = ("ts_ms", "pos"), *,
                 width: int = WIDTH, rows: int | None = ROWS) -> DataFrame:
    """Previous value of ``col`` for the same key and the difference."""
    n = with_neighbors(log, key, order, [col], nxt=False, width=width, rows=rows)
    return (n.withColumn(f"prev_{col}", F.col(f"_prev.{col}"))
            .withColumn("delta", F.col(col) - F.col(f"prev_{col}"))
            .drop("_prev"))


def transitions(log: DataFrame, key: str, col: str, order: Sequence[str] = ("ts_ms", "pos"), *,
                width: int = WIDTH, rows: int | None = ROWS) -> DataFrame:
    """Counts of (previous value -> value) transitions of ``col`` per key order."""
    n = with_neighbors(log, key, order, [col], nxt=False, width=width, rows=rows)
    return (n.groupBy(F.col(f"_prev.{col}").alias(f"prev_{col}"), F.col(col).alias(f"next_{col}"))
            .agg(F.count(F.lit(1)).alias("n")))


def clamped_running(df: DataFrame, key: str, order: Sequence[str], delta: str, start: int | float = 0, *,
                    floor: int | float = 0, width: int = WIDTH, rows: int | None = ROWS) -> DataFrame:
    """Sequential ``x = GREATEST(floor, x + delta)`` per key from ``start``, in
    closed form: with P = start + running sum, x = P - min(0, min(P) - floor)
    (clamping resets exactly by the deepest undershoot so far)."""
    r = with_running_sum(df, key, order, delta, width=width, rows=rows)
    p = F.lit(start) + F.col("_run")
    undershoot = F.least(F.lit(0), F.lit(start) + F.col("_run_min") - F.lit(floor))
    return r.withColumn("level", p - undershoot).drop("_run", "_run_min")
