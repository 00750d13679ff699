"""Branch queries.

The log is split at the fork commit: after the fork commit (half of all), changes
of type ``purchase`` were written on branch ``purchase_trial`` (an experiment
replaying purchases), everything else stays on ``main``. The refs table has
one row per branch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import branches
from tidemark.plans.core_queries import FORK, FORK_SQL, STATE_COLS
from tidemark.plans.registry import register
from tidemark.plans.testdata import commit_at, commit_sql, event_log, with_log

BRANCH = "purchase_trial"
MERGE_COMMIT = 1_000_000_000
SECOND_FORK = 70              # the fork of the trial, in hundredths of the log's commits
_SECOND_SQL = commit_sql(SECOND_FORK)


def branch_log(spark, sf):
    log = event_log(spark, sf)
    on_branch = (F.col("batch_id") > commit_at(spark, sf, FORK)) & (F.col("status") == "purchase")
    return log.withColumn("ref", F.when(on_branch, F.lit(BRANCH)).otherwise(F.lit("main")))


def refs(spark, sf):
    return branches.create_branch(branches.new_refs(spark), BRANCH, "main", commit_at(spark, sf, FORK))


def merged_main(spark, log, catalog, policy: str, source: str = BRANCH):
    """main's state after a merge into it."""
    log, catalog = branches.merge_branch(log, catalog, source, "main", "k", MERGE_COMMIT, policy=policy)
    return branches.read_ref(log, catalog, "main", "k").select(*STATE_COLS)


_BL = (f"bl AS (SELECT *, CASE WHEN batch_id > {FORK_SQL} AND status = 'purchase' THEN '{BRANCH}' "
       "ELSE 'main' END AS ref FROM log)")
_S = "k, op, status, amount, ts_ms, pos"


def _latest(src: str, order: str) -> str:
    return (f"SELECT {_S} FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {order}) AS _rn FROM {src}) "
            "WHERE _rn = 1 AND op <> 'd'")


@register("branch_read", with_log(_latest(
    f"(SELECT *, 1 AS depth FROM bl WHERE ref = '{BRANCH}' UNION ALL "
    f"SELECT *, 0 AS depth FROM bl WHERE ref = 'main' AND batch_id <= {FORK_SQL})",
    "depth DESC, ts_ms DESC, pos DESC"), _BL))
def q_branch_read(spark, sf):
    """``SET SESSION ref = 'purchase_trial'``: base up to the fork + branch writes."""
    return branches.read_ref(branch_log(spark, sf), refs(spark, sf), BRANCH, "k").select(*STATE_COLS)


@register("branch_isolation", with_log(_latest("(SELECT * FROM bl WHERE ref = 'main')", "ts_ms DESC, pos DESC"), _BL))
def q_branch_isolation(spark, sf):
    """``main`` is unchanged by branch writes."""
    return branches.read_ref(branch_log(spark, sf), refs(spark, sf), "main", "k").select(*STATE_COLS)


@register("branch_merge", with_log(_latest(
    "(SELECT *, 0 AS seq FROM bl WHERE ref = 'main' UNION ALL SELECT *, 1 AS seq FROM ("
    f"SELECT k, op, status, amount, ts_ms, pos, batch_id, ref FROM (SELECT *, row_number() OVER (PARTITION BY k "
    f"ORDER BY ts_ms DESC, pos DESC) AS _r FROM bl WHERE ref = '{BRANCH}') WHERE _r = 1))",
    "seq DESC, ts_ms DESC, pos DESC"), _BL))
def q_branch_merge(spark, sf):
    """``CALL merge_branch('purchase_trial', 'main')`` with the branch winning
    conflicting keys; returns main's state after the merge."""
    return merged_main(spark, branch_log(spark, sf), refs(spark, sf), policy="source_wins")


_NET = (f"(SELECT k, op, status, amount, ts_ms, pos FROM (SELECT *, row_number() OVER (PARTITION BY k "
        f"ORDER BY ts_ms DESC, pos DESC) AS _r FROM bl WHERE ref = '{BRANCH}') WHERE _r = 1)")
_BOTH = (f"(SELECT k FROM bl WHERE ref = '{BRANCH}' INTERSECT SELECT k FROM bl WHERE ref = 'main' AND batch_id > {FORK_SQL})")


@register("branch_merge_target_wins", with_log(_latest(
    f"(SELECT *, 0 AS seq FROM bl WHERE ref = 'main' UNION ALL SELECT k, op, status, amount, ts_ms, pos, 0 AS batch_id, 'main' AS ref, 1 AS seq FROM {_NET} "
    f"WHERE k NOT IN {_BOTH})", "seq DESC, ts_ms DESC, pos DESC").replace("SELECT *, 0 AS seq FROM bl", f"SELECT {_S}, batch_id, ref, 0 AS seq FROM bl"), _BL))
def q_branch_merge_target_wins(spark, sf):
    """The merge that keeps keys changed on both sides as they are on ``main``."""
    return merged_main(spark, branch_log(spark, sf), refs(spark, sf), policy="target_wins")


@register("branch_merge_then_write", with_log(_latest(
    f"(SELECT {_S}, 0 AS seq, 0 AS late FROM bl WHERE ref = 'main' UNION ALL SELECT {_S}, 1 AS seq, 0 AS late FROM {_NET} UNION ALL "
    f"SELECT {_S}, 1 AS seq, 1 AS late FROM log WHERE pos % 11 = 0)", "seq DESC, late DESC, ts_ms DESC, pos DESC"), _BL))
def q_branch_merge_then_write(spark, sf):
    """Writes on ``main`` after a merge win over what the merge brought, though their events are older."""
    log, catalog = branches.merge_branch(branch_log(spark, sf), refs(spark, sf), BRANCH, "main", "k", MERGE_COMMIT, policy="source_wins")
    later = event_log(spark, sf).filter("pos % 11 = 0").withColumn("batch_id", F.lit(MERGE_COMMIT + 2).cast("long"))
    catalog = branches.create_branch(catalog, "trial_2", "main", MERGE_COMMIT + 1)
    log, catalog = branches.merge_branch(log.unionByName(branches.write_ref(later, "trial_2"), allowMissingColumns=True), catalog, "trial_2", "main", "k",
                                         MERGE_COMMIT + 3, policy="source_wins")
    return branches.read_ref(log, catalog, "main", "k").select(*STATE_COLS)


@register("branch_nested", with_log(_latest(
    f"(SELECT {_S}, 2 AS depth FROM log WHERE pos % 13 = 0 UNION ALL SELECT {_S}, 1 AS depth FROM bl WHERE ref = '{BRANCH}' AND batch_id <= {_SECOND_SQL} UNION ALL "
    f"SELECT {_S}, 0 AS depth FROM bl WHERE ref = 'main' AND batch_id <= {FORK_SQL})", "depth DESC, ts_ms DESC, pos DESC"), _BL))
def q_branch_nested(spark, sf):
    """A branch of a branch: its own writes, the trial's up to the second fork, ``main`` up to the first."""
    two = branches.create_branch(refs(spark, sf), "nested", BRANCH, commit_at(spark, sf, SECOND_FORK))
    own = branches.write_ref(event_log(spark, sf).filter("pos % 13 = 0"), "nested")
    return branches.read_ref(branch_log(spark, sf).unionByName(own), two, "nested", "k").select(*STATE_COLS)


# What a branch of the trial holds beyond main: its own writes above the trial's up to the second fork.
_NESTED = (f"(SELECT {_S} FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY depth DESC, ts_ms DESC, pos DESC) AS _r FROM ("
           f"SELECT {_S}, 1 AS depth FROM bl WHERE ref = '{BRANCH}' AND batch_id <= {_SECOND_SQL} UNION ALL "
           f"SELECT {_S}, 2 AS depth FROM log WHERE pos % 13 = 0)) WHERE _r = 1)")


def nested_log(spark, sf):
    """The log and catalog with a branch of the trial, ``nested``, that has copies of every 13th change as its own writes."""
    catalog = branches.create_branch(refs(spark, sf), "nested", BRANCH, commit_at(spark, sf, SECOND_FORK))
    own = event_log(spark, sf).filter("pos % 13 = 0").withColumn("batch_id", F.lit(MERGE_COMMIT - 10).cast("long"))
    return branch_log(spark, sf).unionByName(branches.write_ref(own, "nested")), catalog


@register("branch_merge_nested", with_log(_latest(
    f"(SELECT {_S}, 0 AS seq FROM bl WHERE ref = 'main' UNION ALL SELECT {_S}, 1 AS seq FROM {_NESTED})", "seq DESC, ts_ms DESC, pos DESC"), _BL))
def q_branch_merge_nested(spark, sf):
    """A branch of a branch merged into ``main``: the trial's writes up to the second fork come along."""
    return merged_main(spark, *nested_log(spark, sf), policy="source_wins", source="nested")


@register("branch_merge_again", with_log(_latest(
    f"(SELECT {_S}, 0 AS seq FROM bl WHERE ref = 'main' UNION ALL SELECT {_S}, 1 AS seq FROM {_NESTED} UNION ALL "
    f"SELECT {_S}, 2 AS seq FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts_ms DESC, pos DESC) AS _r FROM bl WHERE ref = '{BRANCH}') "
    f"WHERE _r = 1 AND k IN (SELECT k FROM bl WHERE ref = '{BRANCH}' AND batch_id > {_SECOND_SQL}))", "seq DESC, ts_ms DESC, pos DESC"), _BL))
def q_branch_merge_again(spark, sf):
    """After ``nested`` the trial itself: the catalog knows that main has its writes up to the second fork, so only keys written later come."""
    log, catalog = branches.merge_branch(*nested_log(spark, sf), "nested", "main", "k", MERGE_COMMIT, policy="source_wins")
    log, catalog = branches.merge_branch(log, catalog, BRANCH, "main", "k", MERGE_COMMIT + 1, policy="source_wins")
    return branches.read_ref(log, catalog, "main", "k").select(*STATE_COLS)


@register("branch_conflicts_nested", with_log(
    "SELECT a.k, a.source_changes, b.target_changes FROM "
    f"(SELECT k, count(*) AS source_changes FROM (SELECT k FROM bl WHERE ref = '{BRANCH}' AND batch_id <= {_SECOND_SQL} UNION ALL "
    "SELECT k FROM log WHERE pos % 13 = 0) GROUP BY k) a JOIN "
    f"(SELECT k, count(*) AS target_changes FROM bl WHERE ref = 'main' AND batch_id > {FORK_SQL} GROUP BY k) b "
    "ON a.k = b.k", _BL))
def q_branch_conflicts_nested(spark, sf):
    """Keys that main and the branch of the trial both changed since their common history, main at the first fork."""
    return branches.conflicts(*nested_log(spark, sf), "nested", "main", "k")


@register("branch_conflicts", with_log(
    "SELECT a.k, a.source_changes, b.target_changes FROM "
    f"(SELECT k, count(*) AS source_changes FROM bl WHERE ref = '{BRANCH}' GROUP BY k) a JOIN "
    f"(SELECT k, count(*) AS target_changes FROM bl WHERE ref = 'main' AND batch_id > {FORK_SQL} GROUP BY k) b "
    "ON a.k = b.k", _BL))
def q_branch_conflicts(spark, sf):
    """Keys changed on both refs since the fork."""
    return branches.conflicts(branch_log(spark, sf), refs(spark, sf), BRANCH, "main", "k")


@register("branch_list", with_log(
    "SELECT r.name, r.base_ref, r.base_commit, coalesce(h.own_head_commit, r.base_commit) AS head_commit, "
    "coalesce(h.own_changes, 0) AS own_changes FROM (VALUES ('main', NULL, CAST(NULL AS BIGINT)), "
    f"('{BRANCH}', 'main', CAST({FORK_SQL} AS BIGINT))) AS r(name, base_ref, base_commit) LEFT JOIN ("
    "SELECT ref AS name, max(batch_id) AS own_head_commit, count(*) AS own_changes FROM bl GROUP BY ref) h "
    "USING (name)", _BL))
def q_branch_list(spark, sf):
    return branches.branches(refs(spark, sf), branch_log(spark, sf))
