"""Time travel and version operators over a change log.

A log row carries the commit it landed in (``commit`` column, e.g. the
micro-batch id). Reading state "as of" a version or a time is a filter on the
log followed by the fold, so Parquet partition pruning / pushed filters on the
commit column cut the scan. Commit time (when a change became visible in the
replica) and event time (when it happened at the source) are both supported:
they differ for late events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fold import ORDER, latest_state


def commits(log: DataFrame, commit: str = "batch_id", ts: str = "ts_ms") -> DataFrame:
    """One row per commit: ``commit_id``, ``committed_at_ms`` (the last event
    time it contains: a batch commits once its last change is in) and sizes."""
    return (log.groupBy(F.col(commit).alias("commit_id"))
            .agg(F.max(ts).alias("committed_at_ms"), F.min(ts).alias("first_event_ms"),
                 F.count(F.lit(1)).alias("n_changes")))


def with_commit_time(log: DataFrame, commit: str = "batch_id", ts: str = "ts_ms") -> DataFrame:
    """Attach ``committed_at_ms`` to every change (aggregate + join on the
    commit id; the commits side has one row per micro-batch)."""
    c = commits(log, commit, ts).select(F.col("commit_id").alias(commit), "committed_at_ms")
    return log.join(c, commit, "left")


def as_of(log: DataFrame, key: str, t_ms: int, *, by: str = "commit", commit: str = "batch_id",
          order: Sequence[str] = ORDER, commit_times: DataFrame | None = None) -> DataFrame:
    """State as of instant ``t_ms``: by commit time (what a reader of the replica
    saw then, table snapshots) or by event time (what had happened at the source).
    ``commit_times`` (``commit_id, committed_at_ms``, e.g. a store's commit
    rows) overrides commit times derived from the log itself."""
    if by == "event":
        visible = log.filter(F.col(order[0]) <= F.lit(t_ms))
    elif by == "commit":
        if commit_times is not None:
            ok = commit_times.filter(F.col("committed_at_ms") <= F.lit(t_ms)).select(F.col("commit_id").alias(commit))
            visible = log.join(ok, commit, "left_semi")
        else:
            visible = with_commit_time(log, commit, order[0]).filter(F.col("committed_at_ms") <= F.lit(t_ms)) \
                .drop("committed_at_ms")
    else:
        raise ValueError("by must be 'commit' or 'event'")
    return latest_state(visible, key, order)


def as_of_version(log: DataFrame, key: str, version: int, *, commit: str = "batch_id",
                  order: Sequence[str] = ORDER) -> DataFrame:
    """State as of a version (all commits ``<= version``)."""
    return latest_state(log.filter(F.col(commit) <= F.lit(version)), key, order)


def diff(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Key-level diff of two states: ``added / removed / changed / same`` with
    both images. Full outer join on the key; NULL-safe comparison."""
    o = old.select(key, *[F.col(c).alias(f"old_{c}") for c in cols])
    n = new.select(key, *[F.col(c).alias(f"new_{c}") for c in cols])
    j = o.withColumn("_o", F.lit(True)).join(n.withColumn("_n", F.lit(True)), key, "full")
    in_old = F.col("_o").isNotNull()
    in_new = F.col("_n").isNotNull()
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    change = (F.when(in_old & ~in_new, "removed").when(~in_old & in_new, "added")
              .when(same, "same").otherwise("changed"))
    return j.select(key, change.alias("change"), *[f"old_{c}" for c in cols], *[f"new_{c}" for c in cols])


def version_except(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows only in one of two states (multiset ``EXCEPT ALL`` both ways). For two versions of one log, ``log_except``
    gives the same from one scan."""
    return (new.exceptAll(old).withColumn("side", F.lit("added"))
            .unionByName(old.exceptAll(new).withColumn("side", F.lit("removed"))))


def two_states(log: DataFrame, key: str, version: int, cols: Sequence[str], *, commit: str = "batch_id",
               order: Sequence[str] = ORDER, op: str = "op") -> DataFrame:
    """The state as of ``version`` and the current one side by side, from one scan and one shuffle:
    key, ``_old`` and ``_new`` structs of ``cols`` (NULL where the key isn't live)."""
    row, rank = F.struct(F.col(op).alias("_op"), *cols), F.struct(*order)
    old = F.col(commit) <= F.lit(version)
    both = (log.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.max_by(F.when(old, row), F.when(old, rank)).alias("_old"), F.max_by(row, rank).alias("_new")))
    live = lambda c: F.when(F.col(f"{c}._op") != "d", F.struct(*[F.col(f"{c}.{x}").alias(x) for x in cols]))
    return both.select(key, live("_old").alias("_old"), live("_new").alias("_new")).filter("_old IS NOT NULL OR _new IS NOT NULL")


def version_diff(log: DataFrame, key: str, version: int, cols: Sequence[str], **how) -> DataFrame:
    """``diff`` of the state as of ``version`` and the current state of one log."""
    both = two_states(log, key, version, cols, **how)
    change = (F.when(F.col("_new").isNull(), "removed").when(F.col("_old").isNull(), "added")
              .when(F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("changed"))
    return both.select(key, change.alias("change"), *[F.col(f"_old.{c}").alias(f"old_{c}") for c in cols], *[F.col(f"_new.{c}").alias(f"new_{c}") for c in cols])


def log_except(log: DataFrame, key: str, version: int, cols: Sequence[str], **how) -> DataFrame:
    """Rows (key and ``cols``) only in one of the two states: ``side`` is added or removed. Keys are unique in a
    state, so both ``EXCEPT ALL`` are a comparison per key."""
    both = two_states(log, key, version, cols, **how).filter(~F.col("_old").eqNullSafe(F.col("_new")))
    sides = F.explode(F.array(F.struct(F.col("_new").alias("row"), F.lit("added").alias("side")), F.struct(F.col("_old").alias("row"), F.lit("removed").alias("side"))))
    return both.select(key, sides.alias("x")).filter("x.row IS NOT NULL").select(key, *[F.col(f"x.row.{c}").alias(c) for c in cols], F.col("x.side").alias("side"))


def history(log: DataFrame, commit: str = "batch_id", ts: str = "ts_ms", op: str = "op") -> DataFrame:
    """Snapshot history: one row per commit, newest first."""
    return (log.groupBy(F.col(commit).alias("commit_id"))
            .agg(F.max(ts).alias("committed_at_ms"), F.count(F.lit(1)).alias("n_changes"),
                 F.count(F.when(F.col(op) == "c", 1)).alias("n_inserts"),
                 F.count(F.when(F.col(op) == "u", 1)).alias("n_updates"),
                 F.count(F.when(F.col(op) == "d", 1)).alias("n_deletes"))
            .orderBy(F.col("committed_at_ms").desc(), F.col("commit_id").desc()))


def files(df: DataFrame) -> DataFrame:
    """Data files behind a file-based DataFrame: name, size, row count."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("record_count")))


def observed_columns(log: DataFrame, known: Sequence[str], image: str = "after", ts: str = "ts_ms") -> DataFrame:
    """Columns that appear in row images but are not in the spec (schema drift):
    name, how many changes carry it, first and last event time seen."""
    names = log.select(F.explode(F.map_keys(F.col(image))).alias("column_name"), F.col(ts))
    return (names.filter(~F.col("column_name").isin(list(known)))
            .groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("n_changes"), F.min(ts).alias("first_seen_ms"),
                 F.max(ts).alias("last_seen_ms")))


def evolve(*frames: DataFrame) -> DataFrame:
    """Read frames written under older and newer column sets as one: columns are
    matched by name and missing ones are NULL (use ``mergeSchema`` on Parquet
    reads for the same effect on files)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: From narrow to wide: a column may become any later type of a row.
_WIDER = (("byte", "short", "int", "long"), ("float", "double"))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds every value of both: integers widen to longer ones and to decimals, decimals to more
    digits, float to double. Anything else that differs is an error."""
    if a == b:
        return a
    for kinds in _WIDER:
        names = [{"tinyint": "byte", "smallint": "short", "bigint": "long"}.get(t.simpleString(), t.simpleString()) for t in (a, b)]
        if all(n in kinds for n in names):
            return (a, b)[kinds.index(names[1]) > kinds.index(names[0])]
    digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (digits.get(t.simpleString()), 0) for t in (a, b)]
        if all(whole is not None for whole, _ in parts):
            whole, scale = max(p[0] for p in parts), max(p[1] for p in parts)
            if whole + scale <= 38:
                return T.DecimalType(whole + scale, scale)
    raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common wider type")


def merged_schema(*schemas: T.StructType) -> T.StructType:
    """The columns of all generations, in order of appearance, each with its widest type."""
    found: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            found[f.name] = wider(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in found.items()])


def read_generations(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet folders written under older and newer schemas as one scan: columns by name, missing ones NULL, widened types
    read by the Parquet reader itself. Only footers are read to find the schema."""
    return spark.read.schema(merged_schema(*[spark.read.parquet(p).schema for p in paths])).parquet(*paths)


def compact_log(log: DataFrame, path: str, partition_cols: list[str], *, files_per_partition: int = 1,
                mode: str = "errorifexists") -> None:
    """Rewrite an append-only change log (many small per-batch files) into
    ``files_per_partition`` files per partition at ``path``. History is kept:
    every change row is rewritten, none is merged away."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in log.columns]), F.lit(files_per_partition))
    (log.repartition(*[F.col(c) for c in partition_cols], spread)
     .write.mode(mode).partitionBy(*partition_cols).parquet(path))
