"""Folding a change log into state: latest row per key, apply, merge, delete.

The fold is ``groupBy(key).agg(max_by(row, order))``. ``max_by`` is an
aggregate with a partial (map-side) phase, so even a key that holds a third of
all changes is reduced to one row per input partition before the shuffle: hot
keys do not create a hot reducer. Ordering by ``(ts_ms, pos)`` makes the fold
commutative and idempotent: any split of the log, applied in any order, any
number of times, gives the same state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("ts_ms", "pos")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _no_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def latest_state(log: DataFrame, key: str | Sequence[str], order: Sequence[str] = ORDER, *,
                 keep_deletes: bool = False, op_col: str = "op") -> DataFrame:
    """Latest row per key. Deletes win over older upserts of the same key and
    are dropped from the result unless ``keep_deletes`` (tombstones in state)."""
    keys = _keys(key)
    cols = log.columns
    rest = [c for c in cols if c not in keys]
    # Keys come out as the grouping columns themselves (not struct fields), so
    # the result stays hash-partitioned on the key: a later join or fold on the
    # same key reuses that partitioning instead of shuffling again.
    folded = (log.filter(_no_null(keys))
              .groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), _order_struct(order)).alias("_r"))
              .select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in cols]))
    if not keep_deletes:
        folded = folded.filter(F.col(op_col) != "d")
    return folded


def latest_by_rank(log: DataFrame, key: str | Sequence[str], order: Sequence[str] = ORDER, *,
                   keep_deletes: bool = False, op_col: str = "op") -> DataFrame:
    """Latest row per key through ``row_number() = 1``.

    Catalyst turns the rank filter into a partial ``WindowGroupLimit`` below the
    shuffle, so each map task already keeps only its best row per key.
    """
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = (log.filter(_no_null(keys))
              .withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))
    if not keep_deletes:
        ranked = ranked.filter(F.col(op_col) != "d")
    return ranked


def split_ops(folded: DataFrame, op_col: str = "op") -> tuple[DataFrame, DataFrame]:
    """(deletes, upserts) of a folded batch; select the key columns of the
    first for a delete key set. A NULL op lands in neither."""
    return folded.filter(F.col(op_col) == "d"), folded.filter(F.col(op_col) != "d")


def apply_deletes(state: DataFrame, keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``DELETE ... WHERE key IN (SELECT key FROM keys)`` as a left anti join.
    NULL keys are removed first so the plan is a plain (not null-aware) anti join."""
    ks = _keys(key)
    keys = keys.select(*ks).filter(_no_null(ks))
    return state.join(keys, ks, "left_anti")


def matched(state: DataFrame, keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``state`` hit by the key set (left semi join)."""
    ks = _keys(key)
    return state.join(keys.select(*ks), ks, "left_semi")


def apply_batch(state: DataFrame, changes: DataFrame, key: str | Sequence[str], order: Sequence[str] = ORDER, *,
                op_col: str = "op", tombstone_before_ms: int | None = None) -> DataFrame:
    """Next state = fold(state ∪ changes), tombstones kept.

    ``state`` carries the same columns as ``changes`` (including ``op`` and
    the order columns), so the order guard is the fold itself: a replayed or late
    change older than the stored row loses, and a late upsert older than a
    delete cannot bring the key back. Tombstones older than
    ``tombstone_before_ms`` are purged (retention bound).
    """
    nxt = latest_state(state.unionByName(changes), key, order, keep_deletes=True, op_col=op_col)
    if tombstone_before_ms is not None:
        nxt = nxt.filter((F.col(op_col) != "d") | (F.col(order[0]) >= F.lit(tombstone_before_ms)))
    return nxt


def live(state: DataFrame, op_col: str = "op") -> DataFrame:
    """Rows visible to readers (tombstones filtered)."""
    return state.filter(F.col(op_col) != "d")


def merge_state(state: DataFrame, changes: DataFrame, key: str | Sequence[str], order: Sequence[str] = ORDER, *,
                op_col: str = "op") -> DataFrame:
    """``MERGE``: matched -> update, not matched -> insert, delete -> remove.

    The change set is first compacted to one row per key (partial aggregation),
    then full-outer-joined to the state. The newer side by ``order`` wins, so a
    stale change never overwrites newer state. Result keeps tombstones.
    """
    ks = _keys(key)
    cols = [c for c in state.columns]
    c = latest_state(changes.select(*cols), ks, order, keep_deletes=True, op_col=op_col)
    s = state.select(*[F.col(x).alias(f"_s_{x}") if x not in ks else F.col(x) for x in cols])
    n = c.select(*[F.col(x).alias(f"_n_{x}") if x not in ks else F.col(x) for x in cols])
    j = s.join(n, ks, "full")
    s_ord = F.struct(*[F.col(f"_s_{o}") for o in order])
    n_ord = F.struct(*[F.col(f"_n_{o}") for o in order])
    take_new = F.col(f"_n_{order[0]}").isNotNull() & (F.col(f"_s_{order[0]}").isNull() | (n_ord > s_ord))
    return j.select(*[F.col(x) if x in ks else F.when(take_new, F.col(f"_n_{x}")).otherwise(F.col(f"_s_{x}")).alias(x)
                      for x in cols])


def merge_into(table: str, changes: DataFrame, key: str | Sequence[str], order: Sequence[str] = ORDER, *,
               op_col: str = "op") -> None:
    """``MERGE INTO table`` for catalogs with row-level operations (e.g. an
    Iceberg or Delta table), with the same semantics as ``apply_batch``: the
    batch is compacted to one change per key first, and a change older than the stored row
    (by ``order``) is ignored. ``table`` must carry the ``order`` columns. If it carries the op as well, deletes stay as
    rows, so that a late or replayed older upsert can't bring the key back, and readers take ``live``; without it a delete
    removes the row, and an older upsert that comes later is inserted again.
    Plain Parquet tables have no row-level MERGE; use ``ChangeTable`` there.
    """
    ks = _keys(key)
    src = latest_state(changes, ks, order, keep_deletes=True, op_col=op_col).alias("s")
    on = None
    for k in ks:
        c = F.col(f"s.{k}") == F.col(f"{table}.{k}")
        on = c if on is None else on & c
    newer = F.struct(*[F.col(f"s.{o}") for o in order]) > F.struct(*[F.col(f"{table}.{o}") for o in order])
    flagged = op_col in changes.sparkSession.table(table).columns
    cols = {c: F.col(f"s.{c}") for c in changes.columns if flagged or c != op_col}
    ended = F.col(f"s.{op_col}") == "d"
    merge = src.mergeInto(table, on)
    if flagged:
        merge.whenMatched(newer).update(cols).whenNotMatched().insert(cols).merge()
    else:
        merge.whenMatched(newer & ended).delete().whenMatched(newer).update(cols).whenNotMatched(~ended).insert(cols).merge()
