from pyspark.sql import functions as F

from tidemark.operators import analytics, dml, monitor, quality
from tidemark.spec import CUSTOMERS_SPEC


def test_reconcile_all_statuses(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k long, v string")
    rep = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (5, "e")], "k long, v string")
    got = {r.k: r.status for r in analytics.reconcile(src, rep, "k", ["v"]).collect()}
    assert got == {1: "same", 2: "differs", 3: "same", 4: "missing", 5: "extra"}


def test_orphans_ignore_null_fk(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id long, fk long")
    parent = spark.createDataFrame([(10,)], "pk long")
    assert [r.id for r in analytics.orphans(child, "fk", parent, "pk").collect()] == [3]


def test_top_n_and_seeded_sample_are_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert [r.k for r in analytics.top_n(df, 3, [F.col("k").desc()]).collect()] == [999, 998, 997]
    a = [r.k for r in analytics.seeded_sample(df, "k", 5, seed=42).collect()]
    b = [r.k for r in analytics.seeded_sample(df.repartition(7), "k", 5, seed=42).collect()]
    assert a == b and len(set(a)) == 5
    assert [r.k for r in analytics.first_match(df, F.col("k") > 500, "k").collect()] == [501]


def test_dml_statements(spark):
    c = spark.createDataFrame([(1, "bronze"), (2, "silver"), (3, None)], "id long, tier string")
    assert {r.id: r.tier for r in dml.update_by_key(c, "id", 1, {"tier": "platinum"}).collect()}[1] == "platinum"
    counts = spark.createDataFrame([(2, 51), (1, 50)], "id long, n long")
    up = {r.id: r.tier for r in dml.conditional_update(c, "id", counts, "n", 50, {"tier": "platinum"}).collect()}
    assert up == {1: "bronze", 2: "platinum", 3: None}                   # strictly greater than
    assert {r.id: r.tier for r in dml.apply_defaults(c, CUSTOMERS_SPEC.defaults | {"tier": "bronze"}).collect()}[3] \
        == "bronze"
    orders = spark.createDataFrame([(1, "delivered"), (2, "pending")], "id long, status string")
    g = dml.guarded_update(orders, F.col("status") != "delivered", {"status": "shipped"})
    assert {r.id: r.status for r in g.collect()} == {1: "delivered", 2: "shipped"}
    ins = dml.insert_rows(c, spark.createDataFrame([(999, "gold")], "id long, tier string"))
    assert ins.count() == 4


def test_cascade_delete_and_increment(spark):
    orders = spark.createDataFrame([(1, 10.0), (2, 20.0)], "order_id long, total double") \
        .withColumn("total", F.col("total").cast("decimal(12,2)"))
    items = spark.createDataFrame([(1, 1, 2, "5.50"), (2, 1, 1, "3.25"), (3, 2, 1, "1.00")],
                                  "item_id long, order_id long, qty int, price string")
    doomed = spark.createDataFrame([(2,)], "order_id long")
    o2, i2 = dml.cascade_delete(orders, items, "order_id", "order_id", doomed)
    assert [r.order_id for r in o2.collect()] == [1] and sorted(r.item_id for r in i2.collect()) == [1, 2]
    deltas = items.select("order_id", (F.col("qty") * F.col("price").cast("decimal(10,2)")).alias("d"))
    inc = {r.order_id: str(r.total) for r in dml.increment_totals(orders, "order_id", "total", deltas, "d").collect()}
    assert inc == {1: "24.25", 2: "21.00"}


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "a@x", "gold", -1), (1, "a@x", "tin", 5), (2, None, "x" * 20, 0)],
                               "id long, email string, tier string, stock long")
    assert [r.key for r in quality.dq_pk(df, "id", "t").collect()] == ["1"]
    assert [r.key for r in quality.dq_unique(df, "email", "t").collect()] == ["a@x"]
    assert [r.key for r in quality.dq_not_null(df, ["email"], "id", "t").collect()] == ["2"]
    assert [r.detail for r in quality.dq_length(df, {"tier": 16}, "id", "t").collect()] == ["20"]
    dom = quality.dq_domain(df, "tier", ["bronze", "silver", "gold", "platinum"], "id", "t")
    assert sorted(r.detail for r in dom.collect()) == ["tin", "x" * 20]
    assert [r.detail for r in quality.dq_range(df, "stock", "id", "t", lo=0).collect()] == ["-1"]
    s = {(r.rule, r.col): r.violations for r in quality.dq_summary(
        [quality.dq_pk(df, "id", "t"), quality.dq_domain(df, "tier", ["gold"], "id", "t")]).collect()}
    assert s == {("pk_unique", "id"): 1, ("domain", "tier"): 2}
    phones = spark.createDataFrame([(1, "+33-6-12-34-56-78"), (2, "0612")], "id long, phone string")
    assert [r.key for r in quality.dq_shape(phones, "phone", r"^\+33-6(-[0-9]{2}){4}$", "id", "t").collect()] == ["2"]


def test_monitor_rates_lag_and_sla(spark):
    log = spark.createDataFrame([(0, 1, "u", 1), (59_999, 1, "u", 2), (60_000, 2, "c", 3)],
                                "ts_ms long, batch_id long, op string, pos long")
    r = {r.window_start_ms: r.n_changes for r in monitor.change_rate(log, 60_000).collect()}
    assert r == {0: 2, 60_000: 1}
    sl = monitor.sliding_rate(log, "2 minutes", "1 minute").collect()
    assert {(x.window_start_ms, x.n_changes) for x in sl} == {(-60_000, 2), (0, 3), (60_000, 1)}
    lagged = log.withColumn("committed_at_ms", F.lit(120_000))
    lag = monitor.replication_lag(lagged, sla_ms=60_000).first()
    assert (lag.n_changes, lag.max_lag_ms, lag.over_sla) == (3, 120_000, 2)
    metrics = spark.createDataFrame([("batch_duration_s", "b1", 31.0), ("batch_duration_s", "b2", 29.0)],
                                    "metric string, subject string, value double")
    assert [x.subject for x in monitor.sla_breaches(metrics, monitor.limits_frame(spark)).collect()] == ["b1"]
    kl = log.withColumn("topic", F.lit("t")).withColumn("partition", F.lit(0)).withColumn("offset", F.col("pos"))
    read = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, committed_offset long")
    c = monitor.consumer_lag(kl, read).first()
    assert (c.end_offset, c.committed_offset, c.lag_messages) == (3, 2, 1)
    none = monitor.consumer_lag(kl, read.limit(0)).first()
    assert (none.end_offset, none.committed_offset, none.lag_messages) == (3, None, 3)
