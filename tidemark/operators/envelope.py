"""Envelope parsing, quarantine, typed projection, routing and replay dedup.

All narrow (no shuffle) except ``replay_dedup`` and the optional pk->key
resolution join. Bad records are never silently dropped: every row leaves
``parse_envelope`` either valid (``_reason`` NULL) or with a reason, and
``split_valid`` routes the latter to quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.changes import ENVELOPE_SCHEMA
from tidemark.spec import OP_DOMAIN, TableSpec

_PARSE_SCHEMA = T.StructType(ENVELOPE_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType(), True)])
_META = ("key", "topic", "partition", "offset", "timestamp")


def parse_envelope(raw: DataFrame, spec: TableSpec | None = None, *, key: str | None = None,
                   drop_tombstones: bool = True, heartbeat_topics: Sequence[str] = ()) -> DataFrame:
    """Kafka-shaped rows -> one row per change with envelope fields projected.

    Output: ``table, key, op, ts_ms, topic, partition, offset, before, after,
    _reason, _raw`` (the record text, for quarantine). Tombstones (NULL or empty value, emitted after deletes for log
    compaction) and records of ``heartbeat_topics`` are removed here; they are not changes. The key is taken from
    ``after`` and falls back to ``before`` so deletes keep their identity.
    ``drop_tombstones=False`` skips that filter for sources known to carry none
    (it is a filter on ``value``; when ``value`` is itself computed, Catalyst
    would evaluate that computation once more to apply it).
    """
    key_col = key or (spec.key if spec is not None else None)
    value = F.col("value").cast("string")
    meta = [c for c in _META if c in raw.columns and c != "key"]
    if drop_tombstones:
        raw = raw.filter(value.isNotNull() & (value != ""))
    if heartbeat_topics:
        raw = raw.filter(F.col("topic").isNull() | ~F.col("topic").isin(list(heartbeat_topics)))
    # The parse stands behind ``inline``: no filter or projection on its fields can be pushed through it and parse again.
    cdc = F.from_json(value, _PARSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = raw.select(*meta, F.inline(F.array(F.struct(value.alias("_raw"), cdc.alias("cdc")))))
    if key_col is not None:
        k = F.coalesce(F.col("cdc.after")[key_col], F.col("cdc.before")[key_col])
    else:
        k = F.lit(None).cast("string")
    out = parsed.select(
        F.col("cdc.source.table").alias("table"),
        k.alias("key"),
        F.col("cdc.op").alias("op"),
        F.col("cdc.ts_ms").alias("ts_ms"),
        *[F.col(c) for c in meta if c != "timestamp"],
        F.col("cdc.before").alias("before"),
        F.col("cdc.after").alias("after"),
        _reason(spec).alias("_reason"),
        F.col("_raw"),          # original record text, kept for quarantine (pruned when unused)
    )
    return out


def _reason(spec: TableSpec | None) -> Column:
    op = F.col("cdc.op")
    r = (F.when(F.col("cdc").isNull() | F.col("cdc._corrupt_record").isNotNull(), F.lit("malformed"))
         .when(op.isNull() | ~op.isin(*OP_DOMAIN), F.lit("bad_op"))
         .when(F.col("cdc.ts_ms").isNull(), F.lit("bad_ts")))
    if spec is not None:
        r = r.when(F.col("cdc.source.table").isNull() | (F.col("cdc.source.table") != spec.name),
                   F.lit("unknown_table"))
        pk_present = F.coalesce(F.col("cdc.after")[spec.pk_col], F.col("cdc.before")[spec.pk_col]).isNotNull()
        key_present = F.coalesce(F.col("cdc.after")[spec.key], F.col("cdc.before")[spec.key]).isNotNull()
        r = r.when(~key_present & ~pk_present, F.lit("no_key"))
    return r


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined). Both are lazy filters of the same parse; persist the
    input first when both are consumed by separate actions."""
    return parsed.filter(F.col("_reason").isNull()), parsed.filter(F.col("_reason").isNotNull())


def project_typed(parsed: DataFrame, spec: TableSpec, *, state: DataFrame | None = None, resolve_keys: bool = True) -> DataFrame:
    """Map row images -> typed columns from the spec.

    Values come from ``after`` (``before`` for deletes). ``try_cast`` never
    raises under ANSI; a value that is present but does not cast sets
    ``_reason = 'bad_cast:<col>'`` so the row is quarantined instead of failing
    the batch. A missing key is looked up by the source primary key in ``state``
    (a replica with both columns); unresolved rows get ``no_key``.

    The casts are computed once, in one struct behind ``inline``: a filter on ``_reason`` can't
    be pushed through it and repeat the parse.
    """
    cols = spec.typed_columns()
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    two_keys = spec.two_keys
    old = [F.col("before")[spec.key].try_cast(cols[spec.key].dataType).alias("_old_key")] if two_keys else []
    cast = F.struct(*[image[f.name].try_cast(f.dataType).alias(f.name) for f in cols.fields],
                    *[image[f.name].isNotNull().alias(f"_has_{f.name}") for f in cols.fields], *old)
    meta = [c for c in ("table", "topic", "partition", "offset", "_raw") if c in parsed.columns]
    rows = parsed.select("op", "ts_ms", *meta, F.col("_reason").alias("_parse_reason"), F.inline(F.array(cast)))
    bad = F.coalesce(F.col("_parse_reason"), *[F.when(F.col(f"_has_{f.name}") & F.col(f.name).isNull(), F.lit(f"bad_cast:{f.name}")) for f in cols.fields])
    out = rows.select(*[f.name for f in cols.fields], "op", "ts_ms", *meta, bad.alias("_reason"), *(["_old_key"] if two_keys else []))
    if two_keys and not resolve_keys:
        return out
    out = out.drop("_old_key")
    if two_keys and state is not None:
        # Only rows without a key take part in the lookup join; the rest
        # stay narrow.
        lookup = state.select(F.col(spec.pk).alias("_pk"), F.col(spec.key).alias("_key_from_state"))
        keyed = out.filter(F.col(spec.key).isNotNull())
        unkeyed = (out.filter(F.col(spec.key).isNull())
                   .join(lookup, F.col(spec.pk) == F.col("_pk"), "left")
                   .withColumn(spec.key, F.col("_key_from_state"))
                   .drop("_pk", "_key_from_state"))
        out = keyed.unionByName(unkeyed)
    return _without_key(out, spec)


def _without_key(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.withColumn("_reason", F.when(F.col("_reason").isNull() & F.col(spec.key).isNull(), F.lit("no_key")).otherwise(F.col("_reason")))


def with_key_changes(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Add a delete of the old key for every change whose ``before`` holds another key. Expects ``_old_key``."""
    moved = typed.filter(F.col("_reason").isNull() & (F.col("op") != "d") & F.col("_old_key").isNotNull() & ~F.col("_old_key").eqNullSafe(F.col(spec.key)))
    gone = moved.withColumns({spec.key: F.col("_old_key"), "op": F.lit("d")})
    return typed.unionByName(gone).drop("_old_key")


def resolve_keys(typed: DataFrame, spec: TableSpec, state: DataFrame | None, order: tuple[str, ...] = ("ts_ms", "pos")) -> DataFrame:
    """Business keys by the source primary key, for a batch whose key differs from it.

    A row without a key takes the key its primary key had last: in an earlier row of the batch, else in ``state`` (rows with
    both keys, ``op`` where deletes are among them, and the order). A row whose primary key had another key just before
    also deletes that key, so that a renamed row isn't left under its old name; one whose primary key was deleted renames
    nothing. One shuffle of the batch and the state's key columns by the primary key.
    """
    pk, key = spec.pk, spec.key
    good = typed.filter(F.col("_reason").isNull() & F.col(pk).isNotNull())
    rest = typed.filter(F.col("_reason").isNotNull() | F.col(pk).isNull())
    known = good.withColumn("_known", F.lit(False))
    if state is not None:
        kept = [c for c in (pk, key, "op", *order) if c in state.columns]
        base = state.select(*[F.col(c) if c in kept else F.lit(None).cast(t).alias(c) for c, t in good.dtypes])
        known = known.unionByName(base.select(*good.columns).withColumn("_known", F.lit(True)))
    alive = F.col("op").isNull() | (F.col("op") != "d")
    by_pk = Window.partitionBy(pk).orderBy(F.col("_known").desc(), *order, alive).rowsBetween(Window.unboundedPreceding, -1)
    # A delete ends a key's life, but a late PK-only delete of the same row still means that key.
    last = F.last(F.when(alive, F.col(key)), ignorenulls=True).over(by_pk)
    ended = F.last(~alive).over(by_pk)
    seen = known.withColumn("_last", last).withColumn("_ended", F.coalesce(ended, F.lit(False))).filter(~F.col("_known")).drop("_known")
    resolved = seen.withColumn(key, F.coalesce(key, "_last"))
    moved = resolved.filter((F.col("op") != "d") & ~F.col("_ended") & F.col("_last").isNotNull() & (F.col("_last") != F.col(key))).withColumns({key: F.col("_last"), "op": F.lit("d")})
    return _without_key(resolved.unionByName(moved).drop("_last", "_ended").unionByName(rest), spec)


def route(log: DataFrame, tables: list[str], col: str = "table") -> DataFrame:
    """Captured-table allow-list."""
    return log.filter(F.col(col).isin(list(tables)))


def replay_dedup(log: DataFrame, ids: tuple[str, ...] = ("topic", "partition", "offset"),
                 *, watermark_col: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Drop re-delivered copies of the same record (at-least-once replays).

    Batch: ``dropDuplicates`` on the replay identity. Streaming: ``watermark_col`` is the column of
    event times in milliseconds, ``delay`` how late a copy may come; they bound the state.
    """
    if not log.isStreaming:
        return log.dropDuplicates(list(ids))
    if watermark_col is None:
        raise ValueError("a stream needs watermark_col, else its state grows without bound")
    timed = log.withColumn("_event_time", F.timestamp_millis(F.col(watermark_col))).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(ids)).drop("_event_time")
