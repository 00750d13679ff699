"""Queries over the change log: fold, apply, versions, history (SURVEY §2 B6,
C5, D5, E, G, I1, J1-J6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.scalar import changed_columns, minutes_before
from tidemark.operators import fold, ordered, versions
from tidemark.operators.envelope import replay_dedup
from tidemark.plans.registry import register
from tidemark.plans.testdata import commit_at, commit_sql, event_log, table, with_log
from tidemark.session import work_dir
from tidemark.sources.stored_log import StoredLog

STATE_COLS = ["k", "op", "status", "amount", "ts_ms", "pos"]
_S = "k, op, status, amount, ts_ms, pos"

# Fixed parameters of the registered queries.
FORK = 50                             # "as of version" / branch fork point, in hundredths of the log's commits
FORK_SQL = commit_sql(FORK)
AS_OF_UTC = dt.datetime(2024, 1, 15, 12, 0, 0, tzinfo=dt.timezone.utc)
AS_OF_MS = int(AS_OF_UTC.timestamp() * 1000)
MINUTES_AGO = 30


def latest_sql(src: str = "log", keep_deletes: bool = False, cols: str = _S) -> str:
    cond = "" if keep_deletes else " AND op <> 'd'"
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts_ms DESC, pos DESC) AS _rn "
            f"FROM {src}) WHERE _rn = 1{cond}")


LATEST_SQL = with_log(latest_sql())


def state_cols(df):
    return df.select(*STATE_COLS)


@register("latest_state", LATEST_SQL)
def q_latest_state(spark, sf):
    return state_cols(fold.latest_state(event_log(spark, sf), "k"))


@register("latest_by_rank", LATEST_SQL)
def q_latest_by_rank(spark, sf):
    return state_cols(fold.latest_by_rank(event_log(spark, sf), "k"))


@register("live_by_status", with_log(
    "SELECT status, count(*) AS n_keys, CAST(sum(amount) AS DECIMAL(22,2)) AS total_amount "
    f"FROM ({latest_sql()}) GROUP BY status"))
def q_live_by_status(spark, sf):
    """Flagship: replicate the log into current state and report it by status."""
    st = fold.latest_state(event_log(spark, sf), "k")
    return st.groupBy("status").agg(F.count(F.lit(1)).alias("n_keys"),
                                    F.sum("amount").cast("decimal(22,2)").alias("total_amount"))


@register("split_ops", with_log(
    "SELECT k, CASE WHEN op = 'd' THEN 'delete' ELSE 'upsert' END AS kind, ts_ms "
    f"FROM ({latest_sql(keep_deletes=True)})"))
def q_split_ops(spark, sf):
    folded = fold.latest_state(event_log(spark, sf), "k", keep_deletes=True)
    deletes, upserts = fold.split_ops(folded)
    return (deletes.select("k", F.lit("delete").alias("kind"), "ts_ms")
            .unionByName(upserts.select("k", F.lit("upsert").alias("kind"), "ts_ms")))


@register("apply_batch", LATEST_SQL)
def q_apply_batch(spark, sf):
    """State at the fork version (tombstones kept), then every later change
    applied as one batch."""
    fork = commit_at(spark, sf, FORK)
    state = fold.latest_state(event_log(spark, sf, upto_batch=fork), "k", keep_deletes=True)
    nxt = fold.apply_batch(state, event_log(spark, sf, after_batch=fork), "k")
    return state_cols(fold.live(nxt))


@register("merge_upsert", LATEST_SQL)
def q_merge_upsert(spark, sf):
    """MERGE of the later changes into the fork-version state (full outer join form)."""
    fork = commit_at(spark, sf, FORK)
    state = fold.latest_state(event_log(spark, sf, upto_batch=fork), "k", keep_deletes=True)
    merged = fold.merge_state(state, event_log(spark, sf, after_batch=fork), "k")
    return state_cols(fold.live(merged))


_SNAP_SQL = ("snap AS (SELECT c_custkey AS k, 'r' AS op, c_mktsegment AS status, CAST(c_acctbal AS DECIMAL(12,2)) AS amount, "
             "CAST(0 AS BIGINT) AS ts_ms, CAST(-1 AS BIGINT) AS pos, CAST(-1 AS BIGINT) AS batch_id FROM customer), "
             "u AS (SELECT * FROM log UNION ALL SELECT * FROM snap)")


def snapshot_rows(spark, sf):
    c = table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    return c.select(F.col("c_custkey").alias("k"), F.lit("r").alias("op"), F.col("c_mktsegment").alias("status"),
                    F.col("c_acctbal").cast("decimal(12,2)").alias("amount"), F.lit(0).cast("long").alias("ts_ms"),
                    F.lit(-1).cast("long").alias("pos"), F.lit(-1).cast("long").alias("batch_id"))


@register("snapshot_plus_changes", with_log(latest_sql("u"), _SNAP_SQL))
def q_snapshot_plus_changes(spark, sf):
    """Initial snapshot (op 'r', lowest order) followed by the change stream."""
    return state_cols(fold.latest_state(snapshot_rows(spark, sf).unionByName(event_log(spark, sf)), "k"))


@register("as_of_version", with_log(latest_sql(f"(SELECT * FROM log WHERE batch_id <= {FORK_SQL})")))
def q_as_of_version(spark, sf):
    fork = commit_at(spark, sf, FORK)
    return state_cols(versions.as_of_version(event_log(spark, sf, upto_batch=fork), "k", fork))


_COMMIT_SQL = "c AS (SELECT batch_id, max(ts_ms) AS committed_at_ms FROM log GROUP BY batch_id)"


@register("as_of_time", with_log(latest_sql(
    f"(SELECT log.* FROM log JOIN c USING (batch_id) WHERE c.committed_at_ms <= {AS_OF_MS})"), _COMMIT_SQL))
def q_as_of_time(spark, sf):
    """``FOR TIMESTAMP AS OF``: by commit time (snapshot semantics)."""
    return state_cols(versions.as_of(event_log(spark, sf), "k", AS_OF_MS, by="commit"))


@register("as_of_event_time", with_log(latest_sql(f"(SELECT * FROM log WHERE ts_ms <= {AS_OF_MS})")))
def q_as_of_event_time(spark, sf):
    """Same instant by event time: includes changes that happened but were not
    yet committed then."""
    return state_cols(versions.as_of(event_log(spark, sf, upto_ts_ms=AS_OF_MS), "k", AS_OF_MS, by="event"))


@register("as_of_minutes_ago", with_log(latest_sql(
    f"(SELECT log.* FROM log JOIN c USING (batch_id) WHERE c.committed_at_ms <= "
    f"(SELECT max(ts_ms) FROM log) - {MINUTES_AGO} * 60000)"), _COMMIT_SQL))
def q_as_of_minutes_ago(spark, sf):
    """State n minutes before 'now'; 'now' is the newest change time (a scalar
    subquery, not a driver round trip)."""
    log = event_log(spark, sf)
    now_ms = log.agg(F.max("ts_ms")).scalar()
    vis = versions.with_commit_time(log).filter(F.col("committed_at_ms") <= minutes_before(now_ms, MINUTES_AGO))
    return state_cols(fold.latest_state(vis.drop("committed_at_ms"), "k"))


def stored_log(spark, sf) -> StoredLog:
    """The log stored by commit range, in a fresh folder; ``size`` commits make a folder."""
    log = StoredLog(spark, work_dir(spark, "stored-log"), size=16)
    log.write(event_log(spark, sf))
    return log


@register("as_of_stored", with_log(latest_sql(
    f"(SELECT log.* FROM log JOIN c USING (batch_id) WHERE c.committed_at_ms <= {AS_OF_MS})"), _COMMIT_SQL))
def q_as_of_stored(spark, sf):
    """``FOR TIMESTAMP AS OF`` on the stored log: the commits table says which folders are read."""
    return state_cols(stored_log(spark, sf).as_of("k", AS_OF_MS))


@register("as_of_stored_minutes_ago", with_log(latest_sql(
    f"(SELECT log.* FROM log JOIN c USING (batch_id) WHERE c.committed_at_ms <= "
    f"(SELECT max(ts_ms) FROM log) - {7 * 1440} * 60000)"), _COMMIT_SQL))
def q_as_of_stored_minutes_ago(spark, sf):
    """The state a week of minutes before the newest commit, from the stored log."""
    return state_cols(stored_log(spark, sf).as_of_minutes_ago("k", 7 * 1440))


_V_AB = (f"a AS ({latest_sql(f'(SELECT * FROM log WHERE batch_id <= {FORK_SQL})')}), "
         f"b AS ({latest_sql()})")


@register("version_diff", with_log(
    "SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'removed' WHEN a.k IS NULL THEN 'added' "
    "WHEN a.status IS NOT DISTINCT FROM b.status AND a.amount IS NOT DISTINCT FROM b.amount THEN 'same' "
    "ELSE 'changed' END AS change, a.status AS old_status, a.amount AS old_amount, b.status AS new_status, "
    "b.amount AS new_amount FROM a FULL JOIN b ON a.k = b.k", _V_AB))
def q_version_diff(spark, sf):
    fork = commit_at(spark, sf, FORK)
    return versions.version_diff(event_log(spark, sf), "k", fork, ["status", "amount"])


@register("version_except", with_log(
    "(SELECT k, status, amount, 'added' AS side FROM (SELECT k, status, amount FROM b EXCEPT ALL "
    "SELECT k, status, amount FROM a)) UNION ALL (SELECT k, status, amount, 'removed' AS side FROM "
    "(SELECT k, status, amount FROM a EXCEPT ALL SELECT k, status, amount FROM b))", _V_AB))
def q_version_except(spark, sf):
    fork = commit_at(spark, sf, FORK)
    return versions.log_except(event_log(spark, sf), "k", fork, ["status", "amount"])


@register("diff_amount", with_log(
    "SELECT b.k, b.amount - a.amount AS delta FROM b JOIN a USING (k) WHERE b.status = 'purchase'", _V_AB))
def q_diff_amount(spark, sf):
    """Current vs historical state of the same keys, filtered on current; one scan."""
    fork = commit_at(spark, sf, FORK)
    both = versions.two_states(event_log(spark, sf), "k", fork, ["status", "amount"])
    return (both.filter("_old IS NOT NULL AND _new.status = 'purchase'")
            .select("k", (F.col("_new.amount") - F.col("_old.amount")).alias("delta")))


@register("snapshot_history", with_log(
    "SELECT batch_id AS commit_id, max(ts_ms) AS committed_at_ms, count(*) AS n_changes, "
    "count(*) FILTER (WHERE op = 'c') AS n_inserts, count(*) FILTER (WHERE op = 'u') AS n_updates, "
    "count(*) FILTER (WHERE op = 'd') AS n_deletes FROM log GROUP BY batch_id"))
def q_snapshot_history(spark, sf):
    return versions.history(event_log(spark, sf))


_W = "WINDOW w AS (PARTITION BY k ORDER BY ts_ms, pos)"


@register("scd2_history", with_log(
    "SELECT k, status, amount, valid_from, valid_to, valid_to IS NULL AS is_current, pos FROM ("
    "SELECT k, op, status, amount, pos, ts_ms AS valid_from, lead(ts_ms) OVER w AS valid_to FROM log " + _W +
    ") WHERE op <> 'd'"))
def q_scd2_history(spark, sf):
    return ordered.scd2(event_log(spark, sf), "k", ["status", "amount"])


@register("change_delta", with_log(
    "SELECT k, pos, ts_ms, op, amount, lag(amount) OVER w AS prev_amount, amount - lag(amount) OVER w AS delta "
    "FROM log " + _W))
def q_change_delta(spark, sf):
    d = ordered.change_delta(event_log(spark, sf), "k", "amount")
    return d.select("k", "pos", "ts_ms", "op", "amount", "prev_amount", "delta")


@register("clamped_stock", with_log(
    "SELECT k, pos, CAST(p - least(0, min(p) OVER w) AS BIGINT) AS level FROM ("
    "SELECT k, ts_ms, pos, 10 + sum(CASE WHEN op = 'c' THEN 15 ELSE -5 END) OVER w AS p FROM log " + _W + ") " + _W))
def q_clamped_stock(spark, sf):
    """Stock = GREATEST(0, stock + delta) per key: +15 on insert, -5 otherwise, from 10."""
    log = event_log(spark, sf).withColumn("delta", F.when(F.col("op") == "c", 15).otherwise(-5))
    r = ordered.clamped_running(log, "k", ["ts_ms", "pos"], "delta", start=10)
    return r.select("k", "pos", F.col("level").cast("long").alias("level"))


@register("status_transitions", with_log(
    "SELECT prev_status, next_status, count(*) AS n FROM (SELECT lag(status) OVER w AS prev_status, "
    "status AS next_status FROM log " + _W + ") GROUP BY prev_status, next_status"))
def q_status_transitions(spark, sf):
    return ordered.transitions(event_log(spark, sf), "k", "status")


@register("before_after_diff", with_log(
    "SELECT k, pos, concat_ws(',', CASE WHEN prev_pos IS NULL OR prev_amount IS DISTINCT FROM amount THEN 'amount' END, "
    "CASE WHEN prev_pos IS NULL THEN 'k' END, "
    "CASE WHEN prev_pos IS NULL OR prev_status IS DISTINCT FROM status THEN 'status' END) AS changed FROM ("
    "SELECT *, lag(pos) OVER w AS prev_pos, lag(status) OVER w AS prev_status, lag(amount) OVER w AS prev_amount "
    "FROM log " + _W + ") WHERE op = 'u'"))
def q_before_after_diff(spark, sf):
    """Changed-field set of each update: previous row image vs new image,
    compared NULL-safely over the union of both images' fields."""
    n = ordered.with_neighbors(event_log(spark, sf), "k", ["ts_ms", "pos"], ["k", "status", "amount"], nxt=False)
    before = F.when(F.col("_prev").isNotNull(), F.create_map(
        F.lit("k"), F.col("_prev.k").cast("string"), F.lit("status"), F.col("_prev.status"),
        F.lit("amount"), F.col("_prev.amount").cast("string")))
    after = F.create_map(F.lit("k"), F.col("k").cast("string"), F.lit("status"), F.col("status"),
                         F.lit("amount"), F.col("amount").cast("string"))
    return n.filter(F.col("op") == "u").select("k", "pos", changed_columns(before, after).alias("changed"))


@register("replay_dedup", with_log(f"SELECT {_S}, k % 4 AS partition FROM log"))
def q_replay_dedup(spark, sf):
    """At-least-once delivery re-sent commits 40-60; drop copies by
    (topic, partition, offset)."""
    log = event_log(spark, sf).withColumn("topic", F.lit("cdc.sales.events")) \
        .withColumn("partition", F.pmod(F.col("k"), F.lit(4))).withColumn("offset", F.col("pos"))
    replayed = log.unionByName(log.filter(F.col("batch_id").between(40, 60)))
    return replay_dedup(replayed).select(*STATE_COLS, "partition")


# -- hot key: the same operators when one key holds a large share of the log --

_HOT = "CASE WHEN status IN ('view', 'click') THEN -1 ELSE k END"
HOT_LOG_SQL = f"SELECT {_HOT} AS k, op, status, amount, ts_ms, pos, batch_id FROM log"


def hot_key_log(spark, sf):
    """Page views and clicks are attributed to one shared anonymous key (-1),
    which then holds about 40% of all changes."""
    log = event_log(spark, sf)
    return log.withColumn("k", F.when(F.col("status").isin("view", "click"), F.lit(-1).cast("long"))
                          .otherwise(F.col("k")))


@register("hot_key_latest", with_log(latest_sql("hot"), f"hot AS ({HOT_LOG_SQL})"))
def q_hot_key_latest(spark, sf):
    return state_cols(fold.latest_state(hot_key_log(spark, sf), "k"))


@register("hot_key_scd2", with_log(
    "SELECT k, status, amount, valid_from, valid_to, valid_to IS NULL AS is_current, pos FROM ("
    "SELECT k, op, status, amount, pos, ts_ms AS valid_from, lead(ts_ms) OVER w AS valid_to FROM hot " + _W +
    ") WHERE op <> 'd'", f"hot AS ({HOT_LOG_SQL})"))
def q_hot_key_scd2(spark, sf):
    """SCD2 over a log with a hot key: the hot key is cut into range chunks."""
    return ordered.scd2(hot_key_log(spark, sf), "k", ["status", "amount"])


@register("hot_key_clamped_stock", with_log(
    "SELECT k, pos, CAST(p - least(0, min(p) OVER w) AS BIGINT) AS level FROM ("
    "SELECT k, ts_ms, pos, 10 + sum(CASE WHEN op = 'c' THEN 15 ELSE -5 END) OVER w AS p FROM hot " + _W + ") " + _W,
    f"hot AS ({HOT_LOG_SQL})"))
def q_hot_key_clamped_stock(spark, sf):
    log = hot_key_log(spark, sf).withColumn("delta", F.when(F.col("op") == "c", 15).otherwise(-5))
    r = ordered.clamped_running(log, "k", ["ts_ms", "pos"], "delta", start=10)
    return r.select("k", "pos", F.col("level").cast("long").alias("level"))
