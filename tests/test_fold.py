import random

from hypothesis import given, settings
from hypothesis import strategies as st
from tidemark.operators import fold

SCHEMA = "k long, op string, v string, ts_ms long, pos long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_key_tie_broken_by_offset(spark):
    log = spark.createDataFrame([(1, "u", "a", 10, 7), (1, "u", "b", 10, 8)], SCHEMA)
    assert [r.v for r in fold.latest_state(log, "k").collect()] == ["b"]
    assert [r.v for r in fold.latest_by_rank(log, "k").collect()] == ["b"]


def test_late_event_does_not_overwrite(spark):
    state = fold.latest_state(spark.createDataFrame([(1, "u", "new", 10, 1)], SCHEMA), "k", keep_deletes=True)
    late = spark.createDataFrame([(1, "u", "old", 5, 2)], SCHEMA)
    assert [r.v for r in fold.apply_batch(state, late, "k").collect()] == ["new"]
    assert [r.v for r in fold.merge_state(state, late, "k").collect()] == ["new"]


def test_late_upsert_after_delete_stays_deleted(spark):
    state = fold.latest_state(spark.createDataFrame([(1, "d", None, 10, 1)], SCHEMA), "k", keep_deletes=True)
    late = spark.createDataFrame([(1, "u", "zombie", 5, 2)], SCHEMA)
    assert fold.live(fold.apply_batch(state, late, "k")).count() == 0
    assert fold.live(fold.merge_state(state, late, "k")).count() == 0


def test_reinsert_after_delete(spark):
    log = spark.createDataFrame([(1, "c", "a", 1, 1), (1, "d", None, 10, 2), (1, "c", "b", 12, 3)], SCHEMA)
    assert [r.v for r in fold.latest_state(log, "k").collect()] == ["b"]


def test_primary_key_change(spark):
    # A key change arrives as delete(old) + create(new).
    log = spark.createDataFrame([(1, "c", "a", 1, 1), (1, "d", "a", 5, 2), (2, "c", "a", 5, 3)], SCHEMA)
    assert [r.k for r in fold.latest_state(log, "k").collect()] == [2]


def test_replay_is_idempotent(spark):
    log = spark.createDataFrame([(1, "c", "a", 1, 1), (2, "c", "b", 2, 2), (1, "u", "c", 3, 3)], SCHEMA)
    s1 = fold.apply_batch(fold.latest_state(log, "k", keep_deletes=True), log, "k")
    s2 = fold.apply_batch(s1, log, "k")
    assert rows(s1) == rows(s2) == rows(fold.latest_state(log, "k", keep_deletes=True))


def test_deletes_and_semi(spark):
    state = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    keys = spark.createDataFrame([(2,), (None,)], "k long")
    assert [r.k for r in fold.apply_deletes(state, keys, "k").orderBy("k").collect()] == [1, 3]
    assert [r.k for r in fold.matched(state, keys, "k").collect()] == [2]


_event = st.tuples(st.integers(0, 5), st.sampled_from(["c", "u", "d"]), st.integers(0, 30))


@settings(max_examples=15, deadline=None)
@given(st.lists(_event, min_size=1, max_size=40), st.integers(1, 4), st.randoms(use_true_random=False))
def test_fold_is_order_and_split_independent(spark, events, n_batches, rnd: random.Random):
    """Folding any split of a log, in any batch order, gives the same state."""
    data = [(k, op, f"{k}-{i}", ts, i) for i, (k, op, ts) in enumerate(events)]
    whole = rows(fold.live(fold.latest_state(spark.createDataFrame(data, SCHEMA), "k", keep_deletes=True)))
    shuffled = data[:]
    rnd.shuffle(shuffled)
    batches = [shuffled[i::n_batches] for i in range(n_batches)]
    state = spark.createDataFrame([], SCHEMA)
    for b in batches:
        if b:
            state = fold.apply_batch(state, spark.createDataFrame(b, SCHEMA), "k")
    assert rows(fold.live(state)) == whole
    merged = spark.createDataFrame([], SCHEMA)
    for b in batches:
        if b:
            merged = fold.merge_state(merged, spark.createDataFrame(b, SCHEMA), "k")
    assert rows(fold.live(merged)) == whole


def test_split_ops(spark):
    log = spark.createDataFrame([(1, "c", "a", 1, 1), (2, "d", None, 2, 2), (3, None, "x", 1, 3)], SCHEMA)
    folded = fold.latest_state(log, "k", keep_deletes=True)
    d, u = fold.split_ops(folded)
    assert [r.k for r in d.select("k").collect()] == [2]
    assert [r.k for r in u.collect()] == [1]  # NULL op lands in neither


def test_tombstone_retention(spark):
    state = spark.createDataFrame([(1, "d", None, 10, 1), (2, "d", None, 100, 2)], SCHEMA)
    nxt = fold.apply_batch(state, spark.createDataFrame([], SCHEMA), "k", tombstone_before_ms=50)
    assert [r.k for r in nxt.collect()] == [2]


def test_latest_plan_has_partial_aggregation(spark):
    import contextlib
    import io

    log = spark.createDataFrame([(1, "c", "a", 1, 1)], SCHEMA)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        fold.latest_state(log, "k").explain()
    # map-side partial aggregate before the shuffle: hot keys are pre-reduced
    assert "partial_max_by" in buf.getvalue()


def test_snapshot_row_loses_to_later_change(spark):
    # Initial snapshot rows arrive as op 'r' with the lowest order.
    log = spark.createDataFrame([(1, "r", "snap", 0, -1), (1, "u", "live", 5, 3), (2, "r", "only", 0, -1)], SCHEMA)
    assert rows(fold.latest_state(log, "k")) == [(1, "u", "live", 5, 3), (2, "r", "only", 0, -1)]


def test_merge_into_needs_row_level_table(spark, tmp_root):
    import pytest

    # Plain Parquet tables cannot MERGE: the call must fail loudly, never fall
    # back to appending (which would duplicate updated rows).
    spark.sql("CREATE TABLE IF NOT EXISTS tm_merge_t (k long, v string, ts_ms long, pos long) USING parquet")
    changes = spark.createDataFrame([(1, "u", "x", 5, 1)], SCHEMA)
    with pytest.raises(Exception, match="MERGE"):
        fold.merge_into("tm_merge_t", changes, "k")
    assert spark.table("tm_merge_t").count() == 0
    spark.sql("DROP TABLE tm_merge_t")
