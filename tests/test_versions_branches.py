import pytest
from pyspark.sql import functions as F

from tidemark.operators import branches, fold, versions

LOG = "k long, op string, status string, ts_ms long, pos long, batch_id long, ref string"


def test_diff_of_a_version_with_itself_is_all_same(spark):
    from tidemark.plans.testdata import event_log

    log = event_log(spark, "/root/testdata/sf0.001")
    s = versions.as_of_version(log, "k", 5)
    d = versions.diff(s, s, "k", ["status", "amount"])
    assert d.filter(F.col("change") != "same").count() == 0
    assert versions.version_except(s, s).count() == 0


def test_one_scan_diff_equals_the_diff_of_two_folds(spark):
    from tidemark.plans.testdata import event_log

    log = event_log(spark, "/root/testdata/sf0.01").withColumn("k", F.col("k") % 400)
    cols = ["status", "amount"]
    old, new = versions.as_of_version(log, "k", 40), fold.latest_state(log, "k")
    rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)
    one = versions.version_diff(log, "k", 40, cols)
    assert rows(one) == rows(versions.diff(old, new, "k", cols))
    assert rows(versions.log_except(log, "k", 40, cols)) == rows(versions.version_except(old.select("k", *cols), new.select("k", *cols)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_a_branch_of_a_branch_and_writes_after_a_merge(spark):
    log, refs = _branch_setup(spark)
    refs = branches.create_branch(refs, "deep", "ds", 2)
    more = branches.write_ref(spark.createDataFrame([(3, "c", "new", 1, 9, 4)], "k long, op string, status string, ts_ms long, pos long, batch_id long"), "deep")
    deep = {r.k: r.status for r in branches.read_ref(log.unionByName(more), refs, "deep", "k").collect()}
    assert deep == {1: "platinum", 2: "silver", 3: "new", 999: "gold"}
    merged, refs = branches.merge_branch(log, refs, "ds", "main", "k", 50)
    late = branches.write_ref(spark.createDataFrame([(1, "u", "after", 5, 10, 51)], "k long, op string, status string, ts_ms long, pos long, batch_id long"), "main")
    state = branches.read_ref(merged.unionByName(late, allowMissingColumns=True), refs, "main", "k")
    assert {r.k: r.status for r in state.collect()} == {1: "after", 2: "gold", 999: "gold"}
    with pytest.raises(ValueError, match="no branch"):
        branches.ancestors(refs, "absent")


def test_commit_time_and_event_time_differ_for_late_events(spark):
    # The change with ts 50 arrives late, in batch 2 (committed at ts 300).
    log = spark.createDataFrame([(1, "c", "a", 10, 1, 1, "main"), (1, "u", "b", 100, 2, 1, "main"),
                                 (2, "c", "x", 50, 3, 2, "main"), (1, "u", "c", 300, 4, 2, "main")], LOG)
    by_commit = {r.k for r in versions.as_of(log, "k", 120, by="commit").collect()}
    by_event = {r.k for r in versions.as_of(log, "k", 120, by="event").collect()}
    assert by_commit == {1} and by_event == {1, 2}


def _branch_setup(spark):
    log = spark.createDataFrame([
        (1, "c", "bronze", 1, 1, 1, "main"), (2, "c", "silver", 2, 2, 1, "main"),
        (999, "c", "gold", 10, 3, 2, "ds"), (1, "u", "platinum", 11, 4, 2, "ds"),
        (2, "u", "gold", 12, 5, 3, "main")], LOG)
    refs = branches.create_branch(branches.new_refs(spark), "ds", "main", 1)
    return log, refs


def test_branch_isolation_and_read(spark):
    log, refs = _branch_setup(spark)
    main = {r.k: r.status for r in branches.read_ref(log, refs, "main", "k").collect()}
    ds = {r.k: r.status for r in branches.read_ref(log, refs, "ds", "k").collect()}
    assert main == {1: "bronze", 2: "gold"}                     # branch writes invisible on main
    assert ds == {1: "platinum", 2: "silver", 999: "gold"}      # fork at commit 1, main's later write invisible


def test_branch_write_outranks_base_regardless_of_event_time(spark):
    log = spark.createDataFrame([(1, "c", "base", 100, 1, 1, "main"), (1, "u", "branch", 5, 2, 2, "ds")], LOG)
    refs = branches.create_branch(branches.new_refs(spark), "ds", "main", 1)
    assert [r.status for r in branches.read_ref(log, refs, "ds", "k").collect()] == ["branch"]


def test_merge_and_conflicts(spark):
    log, refs = _branch_setup(spark)
    assert [r.k for r in branches.conflicts(log, refs, "ds", "main", "k").collect()] == []
    merged = _main_after(log, refs, "ds")
    assert merged == {1: "platinum", 2: "gold", 999: "gold"}
    # Now a conflicting write on main to key 1 after the fork.
    log2 = log.unionByName(spark.createDataFrame([(1, "u", "silver", 13, 6, 3, "main")], LOG))
    assert [r.k for r in branches.conflicts(log2, refs, "ds", "main", "k").collect()] == [1]
    with pytest.raises(ValueError):
        branches.merge_branch(log2, refs, "ds", "main", "k", 99, policy="fail")
    tw = _main_after(log2, refs, "ds", policy="target_wins")
    assert tw[1] == "silver" and tw[999] == "gold"


def test_merge_of_unchanged_branch_is_noop(spark):
    log, refs = _branch_setup(spark)
    refs2 = branches.create_branch(refs, "empty", "main", 3)
    main = sorted(map(tuple, branches.read_ref(log, refs2, "main", "k").collect()))
    after = sorted(map(tuple, branches.read_ref(*branches.merge_branch(log, refs2, "empty", "main", "k", 99), "main", "k").collect()))
    assert main == after


WRITE = "k long, op string, status string, ts_ms long, pos long, batch_id long"


def _main_after(log, refs, source, commit=99, **how):
    return {r.k: r.status for r in branches.read_ref(*branches.merge_branch(log, refs, source, "main", "k", commit, **how), "main", "k").collect()}


def _written(spark, log, ref, *rows):
    return log.unionByName(branches.write_ref(spark.createDataFrame(list(rows), WRITE), ref), allowMissingColumns=True)


def _keys_on(log, refs, name):
    return {r.k: r.status for r in branches.read_ref(log, refs, name, "k").collect()}


def test_a_nested_branch_brings_its_parents_changes(spark):
    log = spark.createDataFrame([(1, "c", "main", 1, 1, 1, "main")], LOG)
    refs = branches.create_branch(branches.new_refs(spark), "trial", "main", 1)
    log = _written(spark, log, "trial", (2, "c", "trial", 2, 2, 2))
    refs = branches.create_branch(refs, "nested", "trial", 2)
    log = _written(spark, log, "nested", (3, "c", "nested", 3, 3, 3))
    log = _written(spark, log, "trial", (4, "c", "after the fork", 4, 4, 4))
    assert _main_after(log, refs, "nested") == {1: "main", 2: "trial", 3: "nested"}
    assert branches.merge_base(refs, "nested", "main") == {"main": 1}
    assert branches.merge_base(refs, "nested", "trial") == {"main": 1, "trial": 2}
    # The trial afterwards brings only what main hasn't got, and a second time nothing.
    log, refs = branches.merge_branch(log, refs, "nested", "main", "k", 10)
    assert sorted(r.k for r in branches.changed_keys(log, refs, "trial", "k", "main").collect()) == [4]
    log, refs = branches.merge_branch(log, refs, "trial", "main", "k", 11)
    assert _keys_on(log, refs, "main") == {1: "main", 2: "trial", 3: "nested", 4: "after the fork"}
    assert branches.changed_keys(log, refs, "trial", "k", "main").count() == 0
    assert [tuple(r)[:3] for r in branches.merges(refs).orderBy("merge_commit").collect()] == [("nested", "main", 10), ("trial", "main", 11)]


def test_the_catalog_remembers_merges_in_both_directions(spark):
    log = spark.createDataFrame([(1, "c", "old", 1, 1, 1, "main"), (2, "c", "old", 1, 2, 1, "main")], LOG)
    refs = branches.create_branch(branches.new_refs(spark), "trial", "main", 1)
    log = _written(spark, log, "trial", (1, "u", "trial", 10, 3, 2))
    log, refs = branches.merge_branch(log, refs, "trial", "main", "k", 3)
    log = _written(spark, log, "main", (1, "u", "main-late", 5, 4, 4))      # older by event time, later by commit
    assert _keys_on(log, refs, "main") == {1: "main-late", 2: "old"}
    # main back into the trial: the trial's own change isn't an incoming one, nor a conflict.
    assert [r.k for r in branches.conflicts(log, refs, "main", "trial", "k").collect()] == []
    log, refs = branches.merge_branch(log, refs, "main", "trial", "k", 5)
    assert _keys_on(log, refs, "trial") == {1: "main-late", 2: "old"}
    assert branches.changed_keys(log, refs, "trial", "k", "main").count() == branches.changed_keys(log, refs, "main", "k", "trial").count() == 0
    # A delete on the trial, merged again: only the trial's later change comes.
    log = _written(spark, log, "trial", (2, "d", None, 20, 5, 6))
    log, refs = branches.merge_branch(log, refs, "trial", "main", "k", 7)
    assert _keys_on(log, refs, "main") == {1: "main-late"}
    log = _written(spark, log, "main", (2, "c", "again", 2, 6, 8))
    assert _keys_on(log, refs, "main") == {1: "main-late", 2: "again"}


def test_a_merge_that_kept_the_targets_rows_isnt_undone_further_on(spark):
    log = spark.createDataFrame([(1, "c", "old", 1, 1, 1, "main")], LOG)
    refs = branches.create_branch(branches.create_branch(branches.new_refs(spark), "a", "main", 1), "b", "main", 1)
    log = _written(spark, _written(spark, log, "a", (1, "u", "a", 50, 2, 2)), "b", (1, "u", "b", 5, 3, 3))
    log, refs = branches.merge_branch(log, refs, "a", "b", "k", 4, policy="target_wins")
    assert _keys_on(log, refs, "b") == {1: "b"}
    log, refs = branches.merge_branch(log, refs, "b", "main", "k", 5)
    assert _keys_on(log, refs, "main") == {1: "b"}
    log, refs = branches.merge_branch(log, refs, "a", "main", "k", 6)       # main has it by way of b
    assert _keys_on(log, refs, "main") == {1: "b"}


def test_branch_names_are_checked(spark):
    refs = branches.create_branch(branches.new_refs(spark), "trial", "main", 1)
    for name, base in (("trial", "main"), ("x", "absent")):
        with pytest.raises(ValueError):
            branches.create_branch(refs, name, base, 1)
    with pytest.raises(ValueError, match="no branch"):
        branches.included(refs, "absent")


def test_branch_list(spark):
    log, refs = _branch_setup(spark)
    got = {r.name: (r.head_commit, r.own_changes) for r in branches.branches(refs, log).collect()}
    assert got == {"main": (3, 3), "ds": (2, 2)}


def test_schema_drift_and_evolve(spark):
    old = spark.createDataFrame([(1, "a")], "k long, status string")
    new = spark.createDataFrame([(2, "b", 7)], "k long, status string, tier long")
    ev = versions.evolve(old, new)
    assert sorted((r.k, r.tier) for r in ev.collect()) == [(1, None), (2, 7)]
    log = spark.createDataFrame([({"k": "1", "status": "a"}, 1), ({"k": "2", "status": "b", "tier": "7"}, 2)],
                                "after map<string,string>, ts_ms long")
    drift = versions.observed_columns(log, ["k", "status"]).collect()
    assert [(r.column_name, r.n_changes, r.first_seen_ms) for r in drift] == [("tier", 1, 2)]
    assert fold is not None


def test_as_of_with_external_commit_times(spark):
    log = spark.createDataFrame([(1, "c", "a", 10, 1, 1, "main"), (1, "u", "b", 20, 2, 2, "main")], LOG)
    ct = spark.createDataFrame([(1, 100), (2, 200)], "commit_id long, committed_at_ms long")
    assert [r.status for r in versions.as_of(log, "k", 150, commit_times=ct).collect()] == ["a"]
    assert [r.status for r in versions.as_of(log, "k", 250, commit_times=ct).collect()] == ["b"]


def test_a_catalog_read_from_storage_works_as_well(spark, tmp_root):
    log, refs = _branch_setup(spark)
    log, refs = branches.merge_branch(log, refs, "ds", "main", "k", 50)
    refs.write.parquet(f"{tmp_root}/refs")
    stored = spark.read.parquet(f"{tmp_root}/refs")
    assert branches.included(stored, "main") == branches.included(refs, "main") and _keys_on(log, stored, "main") == _keys_on(log, refs, "main")
