import json

from pyspark.sql import functions as F

from conftest import ARTICLE, DELETE, INSERT, INVENTORY, ORDER, T0, UPDATE, change, raw_frame
from tidemark.operators import envelope, fold, quality
from tidemark.spec import CUSTOMERS_SPEC, INVENTORY_SPEC, ORDERS_SPEC


def typed(spark, records, spec, topic=None, **kw):
    raw = raw_frame(spark, records, topic or spec.topic)
    p = envelope.parse_envelope(raw, spec)
    return envelope.project_typed(p, spec, **kw).withColumn("pos", F.col("offset"))


def state_of(df, spec):
    return fold.latest_state(df.filter(F.col("_reason").isNull()), spec.key)


def test_insert_update_delete_sequence(spark):
    two = state_of(typed(spark, [INSERT, UPDATE], CUSTOMERS_SPEC), CUSTOMERS_SPEC).collect()
    assert [(r.customer_id, r.loyalty_tier) for r in two] == [(7311, "gold")]
    three = state_of(typed(spark, [INSERT, UPDATE, DELETE], CUSTOMERS_SPEC), CUSTOMERS_SPEC)
    assert three.count() == 0  # the delete's key comes from `before`


def test_delete_beats_older_upsert_in_same_batch(spark):
    # Delivered out of order within one micro-batch: the delete is still newest.
    s = state_of(typed(spark, [DELETE, UPDATE, INSERT], CUSTOMERS_SPEC), CUSTOMERS_SPEC)
    assert s.count() == 0


def test_order_and_inventory_images(spark):
    o = typed(spark, [ORDER], ORDERS_SPEC).collect()[0]
    assert (o.order_id, o.status, str(o.total_amount)) == (5150, "shipped", "49.00")
    inv = typed(spark, [INVENTORY], INVENTORY_SPEC).collect()[0]
    assert (inv.sku, inv.stock_quantity, inv.category) == ("KETTLE/2L", 12, "Küche")


def test_malformed_records_are_quarantined_not_dropped(spark):
    nameless = dict(INSERT, source={"table": None})
    elsewhere = dict(INSERT, source={"table": "orders"})
    bad_ts = dict(INSERT, ts_ms="zz")
    no_op = dict(INSERT, op=None)
    trunc = dict(INSERT, op="t")
    raw = raw_frame(spark, ["{not json", "[1]", "", None, bad_ts, no_op, trunc, nameless, elsewhere, INSERT])
    p = envelope.parse_envelope(raw, CUSTOMERS_SPEC)
    ok, bad = envelope.split_valid(p)
    # NULL and '' are tombstones (log compaction markers), not changes.
    assert p.count() == 8
    assert ok.count() == 1
    reasons = sorted(r._reason for r in bad.collect())
    assert reasons == ["bad_op", "bad_op", "malformed", "malformed", "malformed", "unknown_table", "unknown_table"]


def test_bad_cast_quarantines_row_and_batch_survives(spark):
    o = dict(ORDER, after=dict(ORDER["after"], total_amount="4x"))
    t = typed(spark, [o, ORDER], ORDERS_SPEC)
    rows = sorted((r._reason or "ok") for r in t.collect())
    assert rows == ["bad_cast:total_amount", "ok"]


def test_decimal_exactness(spark):
    o = dict(ORDER, after=dict(ORDER["after"], total_amount=1.50))
    r = typed(spark, [o], ORDERS_SPEC).collect()[0]
    assert str(r.total_amount) == "1.50"


def test_pk_only_delete_resolves_through_state(spark):
    # Inventory is keyed by sku but the source primary key is product_id; a
    # delete with default replica identity only carries the PK.
    state = spark.createDataFrame([(88, "KETTLE/2L")], "product_id int, sku string")
    rows = [change("inventory", "d", before={"product_id": k}, ts_ms=5) for k in (88, 99)]
    t = typed(spark, rows, INVENTORY_SPEC, state=state)
    got = sorted(((r.sku or "-"), (r._reason or "ok")) for r in t.collect())
    assert got == [("-", "no_key"), ("KETTLE/2L", "ok")]


def resolved(spark, records, state=None):
    raw = raw_frame(spark, records, INVENTORY_SPEC.topic)
    t = envelope.project_typed(envelope.parse_envelope(raw, INVENTORY_SPEC), INVENTORY_SPEC, resolve_keys=False)
    t = envelope.with_key_changes(t.withColumn("pos", F.col("offset")), INVENTORY_SPEC)
    return envelope.resolve_keys(t, INVENTORY_SPEC, state)


def test_keys_resolve_within_one_batch(spark):
    new = change("inventory", "c", after=ARTICLE, ts_ms=T0)
    gone = change("inventory", "d", before={"product_id": 88}, ts_ms=T0 + 5)
    unknown = change("inventory", "d", before={"product_id": 99}, ts_ms=T0 + 5)
    got = resolved(spark, [new, gone, unknown])
    assert sorted((r.sku or "-", r.op, r._reason or "ok") for r in got.collect()) == [("-", "d", "no_key"), ("KETTLE/2L", "c", "ok"), ("KETTLE/2L", "d", "ok")]
    assert state_of(got, INVENTORY_SPEC).count() == 0


def test_a_changed_key_deletes_the_old_one(spark):
    new = change("inventory", "c", after=ARTICLE, ts_ms=T0)
    with_image = change("inventory", "u", before={"product_id": 88, "sku": "KETTLE/2L"}, after=ARTICLE | {"sku": "KETTLE/3L"}, ts_ms=T0 + 5)
    pk_only = change("inventory", "u", before={"product_id": 88}, after=ARTICLE | {"sku": "KETTLE/4L"}, ts_ms=T0 + 9)
    assert [r.sku for r in state_of(resolved(spark, [new, with_image, pk_only]), INVENTORY_SPEC).collect()] == ["KETTLE/4L"]
    stored = spark.createDataFrame([(88, "KETTLE/2L", "c", T0, 0)], "product_id int, sku string, op string, ts_ms long, pos long")
    later = resolved(spark, [pk_only], stored)
    assert sorted((r.sku, r.op) for r in later.collect()) == [("KETTLE/2L", "d"), ("KETTLE/4L", "u")]


def test_one_parse_survives_the_filters(spark):
    raw = raw_frame(spark, [INSERT, "{broken"])
    ok, _ = envelope.split_valid(envelope.project_typed(envelope.parse_envelope(raw, CUSTOMERS_SPEC), CUSTOMERS_SPEC))
    plan = ok._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") <= len(CUSTOMERS_SPEC.names) and "Generate inline" in plan


def test_replay_dedup_on_a_stream_needs_and_uses_its_watermark(spark, tmp_root):
    import pytest

    path = f"{tmp_root}/replayed"
    spark.createDataFrame([("t", 0, 1, T0), ("t", 0, 1, T0), ("t", 0, 2, T0 + 1)], "topic string, partition int, offset long, ts_ms long").write.parquet(path)
    stream = spark.readStream.schema("topic string, partition int, offset long, ts_ms long").parquet(path)
    with pytest.raises(ValueError, match="watermark_col"):
        envelope.replay_dedup(stream)
    q = (envelope.replay_dedup(stream, watermark_col="ts_ms").writeStream.format("parquet").option("path", f"{tmp_root}/once")
         .option("checkpointLocation", f"{tmp_root}/ck_once").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_root}/once").count() == 2


def test_round_trip_through_json(spark):
    from tidemark.plans.testdata import event_log
    from tidemark.sources.changes import to_envelopes
    from tidemark.spec import EVENTS_SPEC

    log = event_log(spark, "/root/testdata/sf0.001").select("k", "op", "status", "amount", "ts_ms", "pos")
    raw = to_envelopes(log, EVENTS_SPEC)
    back = envelope.project_typed(envelope.parse_envelope(raw, EVENTS_SPEC), EVENTS_SPEC) \
        .select("k", "op", "status", "amount", "ts_ms", F.col("offset").alias("pos"))
    assert back.exceptAll(log).count() == 0 and log.exceptAll(back).count() == 0


def test_replay_dedup(spark):
    raw = raw_frame(spark, [INSERT, UPDATE])
    again = raw_frame(spark, [INSERT, UPDATE])
    p = envelope.parse_envelope(raw.unionByName(again), CUSTOMERS_SPEC)
    assert envelope.replay_dedup(p).count() == 2


def test_images_rule(spark):
    partial_insert = dict(INSERT, after={"customer_id": "12"})
    no_before_update = dict(UPDATE, before=None)
    keyless_delete = dict(DELETE, before={"name": "x"})
    p = envelope.parse_envelope(raw_frame(spark, [INSERT, partial_insert, no_before_update, keyless_delete]),
                                CUSTOMERS_SPEC)
    got = sorted(r.detail for r in quality.dq_images(p, CUSTOMERS_SPEC).collect())
    assert got == ["delete_without_key", "insert_missing_columns", "update_missing_image"]


def test_changed_columns(spark):
    from tidemark.functions.scalar import changed_columns

    df = spark.createDataFrame([(json.dumps(UPDATE),)], "v string").select(
        F.from_json("v", "before map<string,string>, after map<string,string>").alias("e"))
    got = df.select(changed_columns(F.col("e.before"), F.col("e.after")).alias("c")).first().c
    # Partial before image: fields absent from `before` count as changed.
    assert got == "email,loyalty_tier,name,phone"


def test_quarantine_keeps_raw_record(spark):
    p = envelope.parse_envelope(raw_frame(spark, ["{not json", INSERT]), CUSTOMERS_SPEC)
    _, bad = envelope.split_valid(p)
    assert [r._raw for r in bad.collect()] == ["{not json"]
