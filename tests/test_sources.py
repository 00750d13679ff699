import json

from pyspark.sql import functions as F

from conftest import ARTICLE, DELETE, INSERT, INVENTORY, ORDER, T0, UPDATE, change
from tidemark.sources import tables
from tidemark.sources.changes import RAW_SCHEMA, read_changes
from tidemark.spec import CUSTOMERS_SPEC, INVENTORY_SPEC, ORDERS_SPEC, SPECS
from tidemark.streaming.apply import await_all
from tidemark.streaming.replicate import Warehouse, replicate_all


def _land(spark, path, records, topic, start=0):
    rows = [(None, json.dumps(r), topic, 0, start + i, None) for i, r in enumerate(records)]
    spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_catalog_helpers(spark, tmp_root):
    db = "tm_replica_test"
    made = tables.init_tables(spark, [CUSTOMERS_SPEC, ORDERS_SPEC], database=db, location=f"{tmp_root}/db")
    assert made == [f"{db}.customers", f"{db}.orders"]
    names = {r.tableName for r in tables.list_tables(spark, db).collect() if not r.isTemporary}
    assert names == {"customers", "orders"}
    assert tables.table_or_none(spark, f"{db}.customers") is not None
    assert tables.table_or_none(spark, f"{db}.nope") is None
    cols = tables.table_or_none(spark, f"{db}.orders").schema
    assert str(cols["total_amount"].dataType) == "DecimalType(12,2)"   # money is exact
    df = tables.rows(spark, "a int, b string", [(1, None), (2, "x")])
    assert tables.sql(spark, "SELECT count(b) AS n FROM v", {"v": df}).first().n == 1
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_read_changes_file_twin_and_admission_control(spark, tmp_root):
    path = f"{tmp_root}/topic"
    _land(spark, path, [INSERT], CUSTOMERS_SPEC.topic, 0)
    _land(spark, path, [UPDATE], CUSTOMERS_SPEC.topic, 1)
    _land(spark, path, [ORDER], ORDERS_SPEC.topic, 0)
    batch = read_changes(spark, CUSTOMERS_SPEC, mode="batch", fmt="parquet", path=path)
    assert batch.count() == 2                                   # topic filter
    s = read_changes(spark, CUSTOMERS_SPEC, fmt="parquet", path=path, max_per_trigger=1)
    q = (s.writeStream.format("noop").option("checkpointLocation", f"{tmp_root}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert max(p["batchId"] for p in q.recentProgress) == 2       # one file per trigger: 3 batches
    from tidemark.operators.monitor import progress_frame

    pf = progress_frame(spark, q)
    assert pf.agg(F.sum("num_input_rows")).first()[0] == 2


def test_replicate_all_tables(spark, tmp_root):
    """One query per captured table; all tables (order items too) come from specs."""
    src = f"{tmp_root}/changes"
    _land(spark, src, [INSERT, UPDATE, DELETE], CUSTOMERS_SPEC.topic)
    _land(spark, src, [ORDER], ORDERS_SPEC.topic)
    _land(spark, src, [INVENTORY], INVENTORY_SPEC.topic)
    item = change("order_items", "c", after={"item_id": 31, "order_id": 5150, "product_name": "Kettle, 2 litres", "quantity": 2, "unit_price": "24.50"}, ts_ms=T0 + 70)
    _land(spark, src, [item], SPECS["order_items"].topic)
    wh = Warehouse(spark, f"{tmp_root}/wh")
    specs = [CUSTOMERS_SPEC, ORDERS_SPEC, INVENTORY_SPEC, SPECS["order_items"]]
    qs = replicate_all(wh, specs, lambda spec: read_changes(spark, spec, fmt="parquet", path=src),
                       trigger="availableNow")
    await_all(spark, qs, timeout=300)
    assert wh.read(CUSTOMERS_SPEC).count() == 0                 # inserted, updated, deleted
    o = wh.read(ORDERS_SPEC).first()
    assert (o.order_id, o.status, str(o.total_amount)) == (5150, "shipped", "49.00")
    inv = wh.read(INVENTORY_SPEC).first()
    assert (inv.sku, inv.stock_quantity) == ("KETTLE/2L", 12)
    # A later delete carrying only the primary key resolves to the sku through
    # the replica's state (default replica identity).
    pk_delete = change("inventory", "d", before={"product_id": 88}, ts_ms=T0 + 80)
    _land(spark, src, [pk_delete], INVENTORY_SPEC.topic, start=10)
    qs2 = replicate_all(wh, [INVENTORY_SPEC], lambda spec: read_changes(spark, spec, fmt="parquet", path=src),
                        trigger="availableNow")
    await_all(spark, qs2, timeout=300)
    assert wh.read(INVENTORY_SPEC).count() == 0
    it = wh.read(SPECS["order_items"]).first()
    assert (it.item_id, it.quantity, str(it.unit_price)) == (31, 2, "24.50")
    # The replicas answer plain SQL through views named after the tables.
    wh.register_views(specs)
    rows = spark.sql("SELECT o.order_id, o.total_amount, count(i.item_id) AS n_items FROM orders o "
                     "LEFT JOIN order_items i ON i.order_id = o.order_id GROUP BY o.order_id, o.total_amount").collect()
    assert [(r.order_id, str(r.total_amount), r.n_items) for r in rows] == [(5150, "49.00", 1)]
    assert spark.sql("SELECT count(*) AS n FROM customers").first().n == 0


def test_renames_and_pk_deletes_in_one_batch_and_over_two(spark, tmp_root):
    """An article that is renamed, and one that comes and goes by its primary key only."""
    other = ARTICLE | {"product_id": 89, "sku": "PAN/28"}
    first = [change("inventory", "c", after=ARTICLE, ts_ms=T0), change("inventory", "c", after=other, ts_ms=T0 + 1)]
    then = [change("inventory", "u", before={"product_id": 88}, after=ARTICLE | {"sku": "KETTLE/3L"}, ts_ms=T0 + 2), change("inventory", "d", before={"product_id": 89}, ts_ms=T0 + 3)]
    for name, batches in (("one", [[*first, *then]]), ("two", [first, then])):
        src, wh, start = f"{tmp_root}/{name}", Warehouse(spark, f"{tmp_root}/wh-{name}"), 0
        for rows in batches:
            _land(spark, src, rows, INVENTORY_SPEC.topic, start)
            start += len(rows)
            await_all(spark, replicate_all(wh, [INVENTORY_SPEC], lambda spec, src=src: read_changes(spark, spec, fmt="parquet", path=src), trigger="availableNow"), timeout=300)
        assert [r.sku for r in wh.read(INVENTORY_SPEC).collect()] == ["KETTLE/3L"], name


def test_scale_conf_sizes_partitions():
    from tidemark.session import scale_conf

    c = scale_conf(100 * 2**40, 8000, large_state=True)            # 100 TB on 8000 task slots
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_conf(15 * 2**20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_apply_conf_respects_cluster_settings(spark):
    from tidemark.session import apply_conf

    # spark.checkpoint.dir was set at startup (explicit in the SparkConf): never overridden.
    applied = apply_conf(spark, {"spark.checkpoint.dir": "/elsewhere",
                                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4"})
    assert "spark.checkpoint.dir" not in applied
    assert spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor") == "4"
