"""The stored log prunes folders, exact percentiles, one parse per record, and other plans and rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dml, envelope, fold, monitor, quality, versions
from tidemark.plans.testdata import event_log
from tidemark.sources.changes import read_changes
from tidemark.sources.stored_log import StoredLog
from tidemark.spec import CUSTOMERS_SPEC, EVENTS_SPEC, INVENTORY_SPEC

SF = "/root/testdata/sf0.01"
COLS = ["k", "op", "status", "amount", "ts_ms", "pos"]


def _rows(df):
    return sorted(map(tuple, df.select(*COLS).collect()))


def _files_read(df):
    """Files that the scan of the log opened, by its metrics after the run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        elif name == "FileSourceScanExec" and "/log" in p.relation().location().rootPaths().apply(0).toString():
            found.append(p.metrics().apply("numFiles").value())
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_time_travel_reads_only_the_ranges_that_were_visible(spark, tmp_root):
    source = event_log(spark, SF)
    log = StoredLog(spark, tmp_root, size=10)
    log.write(source)
    log.write(source.filter("batch_id < 10"))                         # a range written again replaces itself
    assert log.read().count() == source.count() and log.commits().count() == source.select("batch_id").distinct().count()
    t = source.filter("batch_id = 24").agg(F.max("ts_ms")).first()[0]
    state = log.as_of("k", t)
    assert _rows(state) == _rows(versions.as_of(source, "k", t))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "commit_range" in plan.split("PartitionFilters: ")[1].split("]")[0]
    every = spark.read.parquet(f"{tmp_root}/log").select(F.input_file_name()).distinct().count()
    near = spark.read.parquet(f"{tmp_root}/log").filter("commit_range <= 2").select(F.input_file_name()).distinct().count()
    assert _files_read(log.as_of("k", t)) == [near] and near < every / 2
    assert _rows(log.as_of_version("k", 24)) == _rows(versions.as_of_version(source, "k", 24))
    assert _files_read(log.as_of_version("k", 24)) == [near]
    assert log.as_of("k", 0).count() == 0
    got = log.with_commit_time().agg(F.sum("committed_at_ms")).first()[0]
    assert got == versions.with_commit_time(source).agg(F.sum("committed_at_ms")).first()[0]


def test_commits_that_are_visible_out_of_order(spark, tmp_root):
    log = spark.createDataFrame([(1, "c", "a", 10, 1, 1), (1, "u", "b", 300, 2, 2), (2, "c", "x", 50, 3, 30)], "k long, op string, status string, ts_ms long, pos long, batch_id long")
    stored = StoredLog(spark, tmp_root, size=10)
    stored.write(log)
    assert sorted((r.k, r.status) for r in stored.as_of("k", 60).collect()) == [(1, "a"), (2, "x")]   # commit 2 came later than 30
    assert sorted((r.k, r.status) for r in stored.as_of_minutes_ago("k", 0).collect()) == [(1, "b"), (2, "x")]


def test_percentiles_equal_sorted_ranks(spark):
    rng = random.Random(4)
    rows = [(g, v) for g in ("a", "b", None) for v in [rng.choice([0, 5, rng.randrange(-10**12, 10**12), rng.randrange(100)]) for _ in range(rng.randrange(1, 400))]]
    rows += [("c", 7), ("d", None)] + [("e", 3)] * 200 + [("e", 9)] * 2
    got = {r.g: (r.p1, r.p50, r.p100) for r in monitor.exact_percentiles(spark.createDataFrame(rows, "g string, v long"), "v", ["g"], (1, 50, 100)).collect()}
    want = {}
    for g in {g for g, v in rows if v is not None}:
        s = sorted(v for h, v in rows if h == g and v is not None)
        want[g] = tuple(s[max(1, -(-len(s) * p // 100)) - 1] for p in (1, 50, 100))
    assert got == want
    whole = monitor.exact_percentiles(spark.createDataFrame(rows, "g string, v long"), "v", [], (50,)).collect()
    assert len(whole) == 1
    assert monitor.exact_percentiles(spark.createDataFrame([], "g string, v long"), "v", ["g"]).collect() == []


def _parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")


def test_every_record_is_parsed_once(spark):
    from __spark_entry__ import queries

    for name in ("dq_images", "parse_quarantine", "quarantine_reasons", "dq_image_rules", "typed_projection"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")
        assert _parses(plan) == 1, name


def test_all_reasons_and_rules_come_out(spark):
    from __spark_entry__ import queries

    reasons = {r.reason for r in queries()["quarantine_reasons"](spark, "/root/testdata/sf0.01").collect()}
    assert reasons == {"ok", "malformed", "bad_op", "bad_ts", "unknown_table", "no_key", "bad_cast:amount"}
    rules = {r.detail for r in queries()["dq_image_rules"](spark, "/root/testdata/sf0.01").collect()}
    assert rules == {"op_domain", "insert_missing_columns", "update_missing_image", "delete_without_key"}
    found = {(r.rule, r.col) for r in queries()["dq_spec"](spark, "/root/testdata/sf0.01").collect()}
    assert found >= {("not_null", "name"), ("not_null", "email"), ("length", "loyalty_tier"), ("pk_unique", "customer_id"), ("unique", "email")}
    for name in ("fk_orphans_replica", "dq_shape_phone"):
        assert queries()[name](spark, "/root/testdata/sf0.01").count() > 0


def test_values_that_are_no_strings_are_kept(spark):
    raw = spark.createDataFrame([(None, '{"op":"c","ts_ms":1,"source":{"table":"events"},"after":{"k":5,"status":"a","amount":1.5}}', "t", 0, 1, None)],
                                "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    row = envelope.project_typed(envelope.parse_envelope(raw, EVENTS_SPEC), EVENTS_SPEC).collect()[0]
    assert (row.k, row.status, str(row.amount), row._reason) == (5, "a", "1.50", None)


def test_null_keys_are_reported(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (2, "c"), (2, "c")], "k long, s string")
    assert sorted((r.key or "-", r.detail) for r in quality.dq_pk(df, "k", "t").collect()) == [("-", "1"), ("2", "3")]
    assert sorted(r.key for r in quality.dq_pk(df, ["k", "s"], "t").collect()) == ["2|NULL", "2|c", "NULL|b"]


def test_a_spec_names_its_own_rules(spark):
    df = spark.createDataFrame([(1, "A", "n", "c", 1, None), (1, "B" * 40, None, "c", 1, None), (None, "A", "n", "c", 1, None)],
                               T.StructType([T.StructField(f.name, T.LongType() if f.name == "product_id" else T.StringType() if isinstance(f.dataType, T.StringType) else T.IntegerType())
                                             for f in INVENTORY_SPEC.columns.fields]))
    got = {(r.rule, r.col, r.key) for r in quality.check_spec(df, INVENTORY_SPEC).collect()}
    assert got == {("not_null", "product_name", "B" * 40), ("length", "sku", "B" * 40), ("pk_unique", "sku", "A"), ("pk_unique", "product_id", "1"), ("pk_unique", "product_id", None)}
    assert {c.rule for c in quality.spec_checks(CUSTOMERS_SPEC)} == {"not_null", "length"}


def test_writers_stamp_what_they_touch(spark):
    now = dt.datetime(2024, 5, 1, 12, 0)
    df = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k long, s string, updated_at timestamp_ntz")
    assert {r.k: (r.s, r.updated_at) for r in dml.update_by_key(df, "k", 1, {"s": "z"}, now=F.lit(now)).collect()} == {1: ("z", now), 2: ("b", None)}
    swapped = dml.update_where(df, F.col("s") == "a", {"s": "b", "k": F.length("s") + 8})   # values are those before the update
    assert sorted((r.k, r.s) for r in swapped.collect()) == [(2, "b"), (9, "b")]
    new = dml.insert_rows(df, spark.createDataFrame([(3, "c")], "k long, s string"), now=F.lit(now))
    assert {r.k: r.updated_at for r in new.collect()} == {1: None, 2: None, 3: now}
    live = dml.update_by_key(df.withColumn("updated_at", F.col("updated_at").cast("timestamp")), "k", 2, {}, now=dml.NOW()).filter("k = 2").first()
    assert live.updated_at is not None
    assert fold.ORDER == ("ts_ms", "pos")


def test_file_sources_refuse_what_only_kafka_has(spark, tmp_root):
    for how in ({"start": "latest"}, {"fail_on_loss": False}):
        with pytest.raises(ValueError, match="file source"):
            read_changes(spark, EVENTS_SPEC, fmt="parquet", path=tmp_root, **how)


def test_heartbeats_are_no_changes(spark):
    raw = spark.createDataFrame([(None, "{}", "__heartbeat.x", 0, 1, None), (None, "{}", "t", 0, 2, None)], "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    assert [r.offset for r in envelope.parse_envelope(raw, EVENTS_SPEC, heartbeat_topics=["__heartbeat.x"]).collect()] == [2]


def test_types_widen_and_nothing_else(spark, tmp_root):
    kinds = lambda a, b: versions.wider(*[T._parse_datatype_string(x) for x in (a, b)]).simpleString()
    assert [kinds(*p) for p in (("int", "bigint"), ("bigint", "int"), ("int", "decimal(12,2)"), ("decimal(5,1)", "decimal(4,3)"), ("float", "double"), ("string", "string"))] == [
        "bigint", "bigint", "decimal(12,2)", "decimal(7,3)", "double", "string"]
    for pair in (("int", "string"), ("double", "bigint"), ("decimal(38,0)", "decimal(38,9)")):
        with pytest.raises(ValueError):
            kinds(*pair)
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(f"{tmp_root}/0")
    spark.sql("SELECT 5000000000L AS a, 'new' AS c").write.parquet(f"{tmp_root}/1")
    got = versions.read_generations(spark, f"{tmp_root}/0", f"{tmp_root}/1")
    assert got.schema.simpleString() == "struct<a:bigint,b:int,c:string>" and sorted(map(tuple, got.collect()), key=str) == [(1, 2, None), (5000000000, None, "new")]
