from pyspark.sql import functions as F

from tidemark.operators import fold
from tidemark.plans.testdata import event_log
from tidemark.streaming.apply import await_all, start_apply, stream_latest
from tidemark.streaming.change_table import ChangeTable

SF = "/root/testdata/sf0.001"
COLS = ["k", "op", "status", "amount", "ts_ms", "pos"]


def _stage(spark, root, n_files=4):
    path = f"{root}/incoming"
    event_log(spark, SF).repartitionByRange(n_files, "pos").write.parquet(path)
    return path, spark.read.parquet(path).schema


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_epochs_replace_themselves_and_replays_change_nothing(spark, tmp_root):
    log = event_log(spark, SF).select(*COLS)
    table = ChangeTable(spark, f"{tmp_root}/r", "k", log.schema)
    assert table.read().count() == 0
    first, rest = log.filter(F.col("pos") < 500), log.filter(F.col("pos") >= 500)
    table.apply(first, 0)
    assert _rows(table.read()) == _rows(fold.latest_state(first, "k"))
    table.apply(rest, 1)
    stored = table.changes().count()
    table.apply(rest, 1)                                  # a retried batch
    table.apply(first, 0, writer="another")               # a replay under a new checkpoint
    assert _rows(table.read()) == _rows(fold.latest_state(log, "k"))
    assert table.changes().filter(~F.col("_metadata.file_path").contains("another")).count() == stored
    trend = {(r.writer, r.version): r.rows for r in table.size_trend().collect()}
    assert set(trend) == {("batch", 0), ("batch", 1), ("another", 0)} and trend["batch", 0] == trend["another", 0]
    before, dead = _rows(table.read()), table.read(live=False).count()
    table.compact()
    assert table.epochs() == [] and _rows(table.read()) == before and table.read(live=False).count() == dead
    table.apply(first, 7)                                 # older changes after the compaction: deletes hold
    assert _rows(table.read()) == before
    table.compact()
    assert _rows(table.read()) == before and len(table._bases()) == 1


def test_a_batch_writes_only_itself_and_half_written_folders_are_skipped(spark, tmp_root):
    schema = "k long, op string, ts_ms long, pos long"
    table = ChangeTable(spark, f"{tmp_root}/big", "k", spark.createDataFrame([], schema).schema)
    table.apply(spark.range(20_000).selectExpr("id as k", "'c' as op", "1L as ts_ms", "id as pos"), 0)
    table.apply(spark.range(100).selectExpr("id as k", "'d' as op", "2L as ts_ms", "id as pos"), 1)
    assert {r.version: r.rows for r in table.size_trend().collect()} == {0: 20_000, 1: 100}
    spark.range(5).selectExpr("id as k", "'c' as op", "9L as ts_ms", "id as pos").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_root}/big/changes/writer=dead/epoch=0")
    assert table.read().count() == 19_900


def test_compact_log_keeps_every_change(spark, tmp_root):
    from tidemark.operators.versions import compact_log

    log = event_log(spark, SF)
    for b in range(3):   # three small appends per commit range
        log.filter(F.col("batch_id") % 3 == b).write.mode("append").partitionBy("batch_id").parquet(f"{tmp_root}/log")
    small = spark.read.parquet(f"{tmp_root}/log")
    compact_log(small, f"{tmp_root}/log_compact", ["batch_id"])
    big = spark.read.parquet(f"{tmp_root}/log_compact")
    assert big.exceptAll(small).count() == 0 and small.exceptAll(big).count() == 0
    assert big.select(F.input_file_name()).distinct().count() == log.select("batch_id").distinct().count()


def test_stream_apply_equals_batch_and_survives_restart(spark, tmp_root):
    path, schema = _stage(spark, tmp_root)
    store = ChangeTable(spark, f"{tmp_root}/replica", "k", event_log(spark, SF).select(*COLS).schema)
    ckpt = f"{tmp_root}/ckpt"

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path).select(*COLS)
        q = start_apply(s, store, ckpt, trigger="availableNow")
        q.awaitTermination()
        assert q.exception() is None

    run()
    n_epochs = len(store.epochs())
    assert n_epochs == 4                                  # one folder per micro-batch
    run()                                                 # restart from the checkpoint: nothing new
    assert len(store.epochs()) == n_epochs
    assert _rows(store.read()) == _rows(fold.latest_state(event_log(spark, SF), "k"))
    # Checkpoint lost: a new query restarts at epoch 0. Its batches are NOT
    # mistaken for the old query's epochs; the replay is absorbed by the
    # ordering guard and the state does not change.
    ckpt = f"{tmp_root}/ckpt_new"
    run()
    assert len(store.epochs()) == 2 * n_epochs
    assert _rows(store.read()) == _rows(fold.latest_state(event_log(spark, SF), "k"))


def test_quarantine_path_in_stream(spark, tmp_root):
    from conftest import INSERT, UPDATE, raw_frame
    from tidemark.operators import envelope
    from tidemark.spec import CUSTOMERS_SPEC

    src = f"{tmp_root}/raw"
    raw_frame(spark, [INSERT, "{broken", UPDATE]).write.parquet(src)
    store = ChangeTable(spark, f"{tmp_root}/cust", "customer_id",
                        spark.createDataFrame([], "customer_id int, name string, email string, phone string, "
                                                     "loyalty_tier string, op string, ts_ms long, pos long").schema)

    def to_changes(batch):
        p = envelope.parse_envelope(batch, CUSTOMERS_SPEC)
        return envelope.project_typed(p, CUSTOMERS_SPEC).withColumn("pos", F.col("offset"))

    s = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = start_apply(s, store, f"{tmp_root}/ckpt2", to_changes=to_changes, quarantine_path=f"{tmp_root}/quarantine",
                    trigger="availableNow")
    q.awaitTermination()
    assert [(r.customer_id, r.loyalty_tier) for r in store.read().collect()] == [(7311, "gold")]
    assert spark.read.parquet(f"{tmp_root}/quarantine").count() == 1


def test_a_retried_batch_quarantines_once(spark, tmp_root):
    from conftest import INSERT, raw_frame
    from tidemark.spec import CUSTOMERS_SPEC
    from tidemark.streaming.replicate import Warehouse, typed_changes

    src, wh, fail = f"{tmp_root}/raw", Warehouse(spark, f"{tmp_root}/wh"), [True]
    raw_frame(spark, [INSERT, "{broken"]).write.parquet(src)
    table = wh.table(CUSTOMERS_SPEC)
    apply = table.apply

    def flaky(*args, **kw):
        apply(*args, **kw)
        if fail.pop() if fail else False:
            raise RuntimeError("lost after writing")

    table.apply = flaky
    for _ in range(2):
        q = start_apply(spark.readStream.schema(spark.read.parquet(src).schema).parquet(src), table, f"{tmp_root}/ck_retry",
                        to_changes=typed_changes(CUSTOMERS_SPEC), quarantine_path=wh.quarantine_path(CUSTOMERS_SPEC), trigger="availableNow")
        try:
            q.awaitTermination()
        except Exception:
            pass
    assert not fail and spark.read.parquet(wh.quarantine_path(CUSTOMERS_SPEC)).count() == 1 and table.changes().count() == 1


def test_stream_latest_equals_batch(spark, tmp_root):
    path, schema = _stage(spark, tmp_root)
    agg = stream_latest(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)
                        .select(*COLS), "k")
    q = agg.writeStream.outputMode("update").format("memory").queryName("latest_t") \
        .option("checkpointLocation", f"{tmp_root}/ck3").trigger(availableNow=True).start()
    q.awaitTermination()
    got = fold.latest_state(spark.table("latest_t").withColumn("_o", F.lit(0)), "k").drop("_o")
    assert _rows(got) == _rows(fold.latest_state(event_log(spark, SF), "k"))


def test_await_all_surfaces_failure(spark, tmp_root):
    import pytest

    path, schema = _stage(spark, tmp_root, 1)

    def boom(df, epoch):
        raise RuntimeError("batch failed")

    q = (spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(boom)
         .option("checkpointLocation", f"{tmp_root}/ck4").trigger(availableNow=True).start())
    with pytest.raises(Exception):
        await_all(spark, {"t": q}, timeout=120)


def test_stream_rate_watermark_drops_only_too_late_events(spark, tmp_root):
    from tidemark.streaming.apply import stream_rate

    src, out = f"{tmp_root}/rate", f"{tmp_root}/rate_out"

    def land_and_run(name, rows):
        spark.createDataFrame(rows, "pos long, ts_ms long").write.parquet(f"{src}/{name}")
        stream = spark.readStream.schema("pos long, ts_ms long").option("recursiveFileLookup", "true").parquet(src)
        q = (stream_rate(stream, "1 minute", watermark="1 hour").writeStream.outputMode("append")
             .format("parquet").option("path", out).option("checkpointLocation", f"{tmp_root}/ck_rate")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    land_and_run("a", [(0, 60_000), (1, 61_000)])
    land_and_run("b", [(2, 7_260_000)])                   # 2 h later: watermark (1 h) passes minute 1
    land_and_run("c", [(3, 62_000), (4, 7_200_000)])      # too late (dropped) / late but in bound (kept)
    land_and_run("d", [(5, 20_000_000)])                  # advance again so minute 120 is emitted
    got = {r.window_start_ms: r.n_changes for r in spark.read.parquet(out).collect()}
    assert got[60_000] == 2 and got[7_200_000] == 1 and got[7_260_000] == 1


def test_stream_static_enrichment(spark, tmp_root):
    from tidemark.operators.analytics import enrich
    from tidemark.sources.tables import read_table

    path, schema = _stage(spark, tmp_root, 2)
    dim = read_table(spark, SF, "customer", ["c_custkey", "c_mktsegment"])
    stream = spark.readStream.schema(schema).parquet(path)
    out = f"{tmp_root}/enriched"
    q = (enrich(stream, dim, "k", "c_custkey", ["c_mktsegment"]).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", f"{tmp_root}/ck_enrich").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    batch = enrich(event_log(spark, SF), dim, "k", "c_custkey", ["c_mktsegment"])
    cols = ["pos", "k", "c_mktsegment"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_a_compaction_beside_a_reader_loses_nothing(spark, tmp_root):
    log = event_log(spark, SF).select(*COLS)
    table = ChangeTable(spark, f"{tmp_root}/r", "k", log.schema)
    table.apply(log.filter("pos < 500"), 0)
    table.apply(log.filter("pos >= 500"), 1)
    reader, trend, want = table.read(), sorted(map(tuple, table.size_trend().collect())), _rows(fold.latest_state(log, "k"))
    table.compact()
    assert _rows(reader) == want and _rows(table.read()) == want      # what the reader listed is still there
    assert sorted(map(tuple, table.size_trend().collect())) == trend  # and the trend knows the merged epochs
    second = table.read()
    table.apply(log.filter("pos >= 900"), 1)                          # a retry after its epoch was merged: read again
    assert len(table.epochs()) == 1 and _rows(table.read()) == want
    table.compact()
    assert _rows(second) == want and _rows(table.read()) == want and table.epochs() == []
    assert {(r.writer, r.version): r.rows for r in table.size_trend().collect()}["batch", 0] == {t[:2]: t[3] for t in trend}["batch", 0]
    assert table.changes(without=(1, "batch")).count() == table.changes().count()


def _article(pk, sku, op="u", ts=0, before=None, **more):
    from conftest import ARTICLE, change

    after = None if op == "d" else ARTICLE | {"product_id": pk, "sku": sku} | more
    return change("inventory", op, before=before, after={k: v for k, v in after.items() if v is not None} if after else None, ts_ms=ts)


def test_primary_keys_are_found_in_the_index_of_the_batches_buckets(spark, tmp_root):
    from conftest import raw_frame
    from tidemark.spec import INVENTORY_SPEC
    from tidemark.streaming.replicate import Warehouse, typed_changes

    wh = Warehouse(spark, f"{tmp_root}/wh")
    index, table = wh.key_index(INVENTORY_SPEC), wh.table(INVENTORY_SPEC)
    step, at = typed_changes(INVENTORY_SPEC, index), [0]

    def batch(epoch, *records):
        raw = raw_frame(spark, list(records), topic="cdc.sales.inventory", start_offset=at[0])
        at[0] += len(records)
        with step.epoch(raw, epoch, "w") as rows:
            table.apply(rows.filter("_reason is null"), epoch, writer="w")
            return sorted((r.product_id, r.sku, r.op, r._reason) for r in rows.collect())

    def stock():
        return sorted((r.product_id, r.sku) for r in table.read().collect())

    batch(0, *[_article(i, f"S{i}", "c", 1) for i in range(1, 40)])
    assert spark.read.parquet(f"{index.root}/writer=w/epoch=0").count() == 39
    batch(1, _article(1, "S1", ts=2, stock_quantity=5))
    assert spark.read.schema(index.schema).parquet(f"{index.root}/writer=w/epoch=1").count() == 0   # nothing new to remember
    for _ in range(2):                                                        # renamed without a before image; the second run is a retry
        assert batch(2, _article(2, "S2new", ts=3)) == [(2, "S2", "d", None), (2, "S2new", "u", None)]
    assert (2, "S2new") in stock() and (2, "S2") not in stock()
    assert batch(3, _article(3, None, "d", 4, before={"product_id": "3"})) == [(3, "S3", "d", None)]  # a delete that has the primary key only
    assert (3, "S3") not in stock()
    # S3 goes to another article; the old primary key comes back under another name and must not end it.
    batch(4, _article(50, "S3", "c", 5))
    assert batch(5, _article(3, "S3b", "c", 6)) == [(3, "S3b", "c", None)]
    assert {(50, "S3"), (3, "S3b")} <= set(stock())
    assert batch(6, _article(99, None, "d", 7, before={"product_id": "99"}))[0][3] == "no_key"
    before = stock()
    index.compact()
    assert batch(7, _article(2, "S2last", ts=8)) == [(2, "S2last", "u", None), (2, "S2new", "d", None)] and len(stock()) == len(before)
    index.rebuild(table.read(live=False))
    assert batch(8, _article(3, None, "d", 9, before={"product_id": "3"})) == [(3, "S3b", "d", None)]
    # Only the buckets of the batch's primary keys are read.
    asked = spark.createDataFrame([(5,)], "product_id int")
    plan = index.lookup(asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and [r.sku for r in index.lookup(asked).collect()] == ["S5"]


def test_late_rows_are_kept_and_counted_rows_count_once(spark, tmp_root):
    from tidemark.streaming.rates import RateTable

    table = RateTable(spark, f"{tmp_root}/rates", window_ms=60_000, delay_ms=3_600_000, by=["k"])
    assert table.counts() is None and table.late() is None
    batches = [[(0, 60_000, "a"), (1, 61_000, "a"), (2, None, "a")], [(3, 7_260_000, "a")], [(4, 62_000, "a"), (5, 3_700_000, "b"), (6, 3_600_000, "b")], [(7, 9_000_000, "a")]]

    def run(epoch):
        table.apply(spark.createDataFrame(batches[epoch], "pos long, ts_ms long, k string"), epoch)

    for epoch in range(4):
        run(epoch)
        run(epoch)                                        # a retry leaves the same
    assert {(r.window_start_ms, r.k): r.n_changes for r in table.counts().collect()} == {(60_000, "a"): 2, (7_260_000, "a"): 1, (3_660_000, "b"): 1, (9_000_000, "a"): 1}
    late = {r.pos: (r.epoch, r.watermark_ms) for r in table.late().collect()}
    assert late == {2: (0, None), 4: (2, 3_660_000), 6: (2, 3_660_000)}      # row 5 is within the delay
    again = RateTable(spark, table.root, window_ms=60_000, delay_ms=3_600_000, by=["k"], generation=1)
    again.apply(spark.createDataFrame(batches[0], "pos long, ts_ms long, k string"), 0)
    assert {r.window_start_ms for r in table.counts().collect()} == {60_000}  # a new generation starts anew


def test_late_rows_over_a_restart(spark, tmp_root):
    from tidemark.streaming.rates import RateTable

    table, src = RateTable(spark, f"{tmp_root}/rates", window_ms=60_000, delay_ms=1_000), f"{tmp_root}/in"
    for rows in ([(1, 100_000)], [(2, 98_000), (3, 99_500)], [(4, 200_000)], [(5, 198_999), (6, 199_000)]):
        spark.createDataFrame(rows, "pos long, ts_ms long").write.mode("append").parquet(src)
        table.start(spark.readStream.schema("pos long, ts_ms long").parquet(src), f"{tmp_root}/ck", "availableNow").awaitTermination()
    assert sorted((r.pos, r.epoch) for r in table.late().collect()) == [(2, 1), (5, 3)]
    assert sum(r.n_changes for r in table.counts().collect()) == 4


def test_every_progress_report_is_kept(spark, tmp_root):
    from tidemark.streaming.progress import ProgressLog

    src, n = f"{tmp_root}/in", 5
    for i in range(n):
        spark.range(i + 1).coalesce(1).write.mode("append").parquet(src)
    log = ProgressLog(spark, f"{tmp_root}/progress")
    assert log.frame().collect() == []
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.streams.addListener(log)
    try:
        q = (spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(src).writeStream.format("noop")
             .option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        log.wait(q)
        assert len(q.recentProgress) < n
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    rows = log.frame().filter("num_input_rows > 0").orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == list(range(n)) and sorted(r.num_input_rows for r in rows) == list(range(1, n + 1))
    assert {r.query_id for r in rows} == {str(q.id)} and all(r.trigger_ms >= 0 for r in rows)
