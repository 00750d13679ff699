import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordered

SCHEMA = "k long, ts_ms long, pos long, v long, s string"


def skewed_log(spark, n=3000, hot_share=0.34, seed=7):
    """One key holds a third of all rows; the rest spread over 50 keys."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < hot_share else rnd.randint(1, 50)
        rows.append((k, rnd.randint(0, 500), i, rnd.randint(-20, 20), rnd.choice(["a", "b", "c"])))
    return spark.createDataFrame(rows, SCHEMA)


def with_nulls(spark):
    """NULL deltas (also as the first rows of a chunk), NULL order times, ties and rows without a key."""
    log = skewed_log(spark, n=1500)
    return log.select(F.when(F.col("pos") % 41 != 0, F.col("k")).alias("k"), F.when(F.col("pos") % 97 != 0, F.col("ts_ms")).alias("ts_ms"), "pos",
                      F.when((F.col("ts_ms") % 60 > 12) & (F.col("pos") % 3 > 0), F.col("v")).alias("v"), "s")


def test_hot_key_is_split_across_chunks(spark):
    ch = ordered.chunked(skewed_log(spark), "k", ["ts_ms", "pos"], 60)
    assert ch.filter(F.col("k") == 0).select(ordered.CHUNK).distinct().count() == 9


def test_neighbors_match_plain_window(spark):
    w = Window.partitionBy("k").orderBy("ts_ms", "pos")
    for log in (skewed_log(spark), with_nulls(spark)):
        ref = sorted(map(tuple, log.filter("k is not null").select("pos", F.lag("v").over(w).alias("p"), F.lead("s").over(w).alias("n")).collect()), key=str)
        for width in (7, 60, 10**6):
            got = ordered.with_neighbors(log, "k", ["ts_ms", "pos"], ["v", "s"], width=width).select("pos", F.col("_prev.v").alias("p"), F.col("_next.s").alias("n"))
            assert sorted(map(tuple, got.collect()), key=str) == ref, width


def test_running_sum_matches_plain_window(spark):
    w = Window.partitionBy("k").orderBy("ts_ms", "pos").rowsBetween(Window.unboundedPreceding, 0)
    for log in (skewed_log(spark), with_nulls(spark)):
        ref = sorted(map(tuple, log.filter("k is not null").withColumn("r", F.sum("v").over(w)).withColumn("m", F.min("r").over(w)).select("pos", "r", "m").collect()), key=str)
        for width in (7, 60, 10**6):
            got = ordered.with_running_sum(log, "k", ["ts_ms", "pos"], "v", width=width).select("pos", F.col("_run").alias("r"), F.col("_run_min").alias("m"))
            assert sorted(map(tuple, got.collect()), key=str) == ref, width


def test_the_log_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ordered.with_neighbors(skewed_log(spark), "k", ["ts_ms", "pos"], ["v"], width=60)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 4 and "rangepartitioning" not in plan  # the log, the combined summary, its window, its way back


def test_clamped_running_equals_sequential_fold(spark):
    log = skewed_log(spark, n=800)
    got = {r.pos: r.level for r in
           ordered.clamped_running(log, "k", ["ts_ms", "pos"], "v", start=10, width=60).collect()}
    expected = {}
    by_key = {}
    for r in sorted(log.collect(), key=lambda r: (r.k, r.ts_ms, r.pos)):
        x = by_key.get(r.k, 10)
        x = max(0, x + r.v)
        by_key[r.k] = x
        expected[r.pos] = x
    assert got == expected


def test_scd2_intervals_close_on_delete(spark):
    log = spark.createDataFrame(
        [(1, "c", "a", 1, 1), (1, "u", "b", 5, 2), (1, "d", "b", 9, 3), (1, "c", "z", 12, 4)],
        "k long, op string, status string, ts_ms long, pos long")
    got = sorted((r.status, r.valid_from, r.valid_to, r.is_current)
                 for r in ordered.scd2(log, "k", ["status"]).collect())
    assert got == [("a", 1, 5, False), ("b", 5, 9, False), ("z", 12, None, True)]


def test_transitions(spark):
    log = spark.createDataFrame([(1, "x", 1, 1), (1, "y", 2, 2), (1, "x", 3, 3), (2, "x", 1, 4)],
                                "k long, status string, ts_ms long, pos long")
    got = sorted((r.prev_status or "-", r.next_status, r.n) for r in ordered.transitions(log, "k", "status").collect())
    assert got == [("-", "x", 2), ("x", "y", 1), ("y", "x", 1)]


def test_a_busy_slice_of_a_hot_key_is_cut_by_its_own_rows(spark):
    log = skewed_log(spark)
    burst = log.withColumn("ts_ms", F.when(F.col("pos") % 5 == 0, 250).otherwise(F.col("ts_ms")))      # a fifth of all rows at one instant
    for frame, width, least in ((log, 10**6, 8), (burst, 10**6, 6), (log.withColumn("ts_ms", F.lit(3)), 60, 8)):
        ch, chunk = ordered.parted(ordered.chunked(frame, "k", ["ts_ms", "pos"], width), ["k"], ["ts_ms", "pos"], 100)
        sizes = {tuple(r[:3]): r["count"] for r in ch.groupBy("k", *chunk).count().collect()}
        hot = [n for k, n in sizes.items() if k[0] == 0]
        assert len(hot) >= least and len([k for k in sizes if k[0] == 1]) == 1      # only what is too large is cut
    assert max(hot) <= 300


def test_cut_slices_match_plain_windows(spark):
    w = Window.partitionBy("k").orderBy("ts_ms", "pos")
    for log in (skewed_log(spark), with_nulls(spark), skewed_log(spark).withColumn("ts_ms", F.lit(3))):
        keyed = log.filter("k is not null")
        near = sorted(map(tuple, keyed.select("pos", F.lag("v").over(w), F.lead("s").over(w)).collect()), key=str)
        sums = sorted(map(tuple, keyed.withColumn("r", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                          .withColumn("m", F.min("r").over(w.rowsBetween(Window.unboundedPreceding, 0))).select("pos", "r", "m").collect()), key=str)
        for width, rows in ((60, 20), (10**6, 100)):
            got = ordered.with_neighbors(log, "k", ["ts_ms", "pos"], ["v", "s"], width=width, rows=rows).select("pos", "_prev.v", "_next.s")
            assert sorted(map(tuple, got.collect()), key=str) == near
            got = ordered.with_running_sum(log, "k", ["ts_ms", "pos"], "v", width=width, rows=rows).select("pos", "_run", "_run_min")
            assert sorted(map(tuple, got.collect()), key=str) == sums
