"""Queries over replica tables (the provided TPC-H-style tables stand in for
the replicated customers / orders / order items / inventory): scans, joins,
KPIs, top-n, DML as transformations and data-quality rules (SURVEY §2 A10-A11,
A18, B7-B12, C1-C9, D1-D3, D6-D7, F, H10-H13, I2-I7, N)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import derive_email, phone_format
from tidemark.operators import analytics, dml, fold, quality, versions
from tidemark.plans.registry import register
from tidemark.plans.testdata import commit_at, commit_sql, event_log, table, with_log
from tidemark.sources.tables import read_source, rows, scan
from tidemark.spec import CUSTOMERS_SPEC, OP_DOMAIN

# Fixed parameters of the registered queries.
TOP_N = 10
ORDER_THRESHOLD = 20          # "customers with more than N orders"
RECONCILED_UPTO = 90          # the replica's last commit, in hundredths of the log's commits
PHONE_PATTERN = r"^\+33-6(-[0-9]{2}){4}$"


def _t(spark, sf, name, cols=None):
    return table(spark, sf, name, cols)


@register("source_scan", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def q_source_scan(spark, sf):
    """Source database scan (JDBC with partitioned range reads in production;
    the Parquet twin here, as no database runs in this environment)."""
    src = read_source(spark, f"{sf}/customer.parquet", "sales.customers", partition_column="c_custkey")
    return src.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@register("scan_limit", f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {TOP_N}")
def q_scan_limit(spark, sf):
    return scan(_t(spark, sf, "orders"), TOP_N, ["o_orderkey"])


@register("values_scan", with_log(
    "SELECT v.op, v.op_name, coalesce(n.n_changes, 0) AS n_changes FROM (VALUES ('c', 'insert'), ('u', 'update'), "
    "('d', 'delete'), ('r', 'snapshot read')) AS v(op, op_name) LEFT JOIN (SELECT op, count(*) AS n_changes FROM log "
    "GROUP BY op) n USING (op)"))
def q_values_scan(spark, sf):
    """Literal rows (VALUES) joined to aggregates of the log."""
    names = rows(spark, "op string, op_name string",
                 [("c", "insert"), ("u", "update"), ("d", "delete"), ("r", "snapshot read")])
    counts = event_log(spark, sf).groupBy("op").agg(F.count(F.lit(1)).alias("n_changes"))
    return (names.join(counts, "op", "left")
            .select("op", "op_name", F.coalesce(F.col("n_changes"), F.lit(0)).alias("n_changes")))


@register("filter_in_list", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (1, 999)")
def q_filter_in_list(spark, sf):
    return _t(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"]).filter(F.col("c_custkey").isin(1, 999))


@register("filter_eq", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_filter_eq(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    return o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@register("filter_ne", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def q_filter_ne(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    return o.filter(F.col("o_orderstatus") != "F")


@register("join_inner",
          "SELECT c.c_custkey, c.c_name, c.c_mktsegment, o.o_orderkey, o.o_totalprice, o.o_orderstatus "
          "FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey ORDER BY o.o_totalprice DESC")
def q_join_inner(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    return (c.join(o, c.c_custkey == o.o_custkey)
            .select("c_custkey", "c_name", "c_mktsegment", "o_orderkey", "o_totalprice", "o_orderstatus")
            .orderBy(F.col("o_totalprice").desc()))


@register("join_federated", with_log(
    "SELECT c.c_custkey, c.c_name, s.status, s.amount FROM customer c JOIN ("
    "SELECT k, status, amount FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts_ms DESC, pos DESC) AS rn "
    "FROM log) WHERE rn = 1 AND op <> 'd') s ON s.k = c.c_custkey"))
def q_join_federated(spark, sf):
    """Source-database table joined with the replica built from the log."""
    src = read_source(spark, f"{sf}/customer.parquet", "sales.customers").select("c_custkey", "c_name")
    rep = fold.latest_state(event_log(spark, sf), "k").select("k", "status", "amount")
    return src.join(rep, src.c_custkey == rep.k).select("c_custkey", "c_name", "status", "amount")


@register("orders_per_customer", "SELECT o_custkey, count(*) AS total_orders FROM orders GROUP BY o_custkey")
def q_orders_per_customer(spark, sf):
    return analytics.count_by(_t(spark, sf, "orders", ["o_custkey"]), "o_custkey", "total_orders")


@register("conditional_update",
          "SELECT c.c_custkey, CASE WHEN coalesce(n.total_orders, 0) > 20 THEN 'PLATINUM' ELSE c.c_mktsegment END "
          "AS c_mktsegment, coalesce(n.total_orders, 0) AS total_orders FROM customer c LEFT JOIN ("
          "SELECT o_custkey, count(*) AS total_orders FROM orders GROUP BY o_custkey) n ON n.o_custkey = c.c_custkey")
def q_conditional_update(spark, sf):
    """``UPDATE customers SET tier = 'platinum' WHERE total_orders > N``."""
    c = _t(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    n = analytics.count_by(_t(spark, sf, "orders", ["o_custkey"]), "o_custkey", "total_orders") \
        .withColumnRenamed("o_custkey", "c_custkey")
    return dml.conditional_update(c, "c_custkey", n, "total_orders", ORDER_THRESHOLD, {"c_mktsegment": "PLATINUM"}) \
        .select("c_custkey", "c_mktsegment", "total_orders")


_DELETED = "(SELECT k FROM log WHERE op = 'd')"


@register("delete_anti", with_log(
    f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN {_DELETED}"))
def q_delete_anti(spark, sf):
    """Replica minus every key a delete event names (``DELETE ... WHERE key IN``)."""
    keys = event_log(spark, sf).filter(F.col("op") == "d").select(F.col("k").alias("c_custkey"))
    return fold.apply_deletes(_t(spark, sf, "customer", ["c_custkey", "c_name"]), keys, "c_custkey")


@register("delete_semi", with_log(f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN {_DELETED}"))
def q_delete_semi(spark, sf):
    keys = event_log(spark, sf).filter(F.col("op") == "d").select(F.col("k").alias("c_custkey"))
    return fold.matched(_t(spark, sf, "customer", ["c_custkey", "c_name"]), keys, "c_custkey")


@register("reconcile", with_log(
    "SELECT coalesce(s.k, r.k) AS k, CASE WHEN r.k IS NULL THEN 'missing' WHEN s.k IS NULL THEN 'extra' "
    "WHEN s.status IS NOT DISTINCT FROM r.status AND s.amount IS NOT DISTINCT FROM r.amount THEN 'same' "
    "ELSE 'differs' END AS status, s.status AS src_status, s.amount AS src_amount, r.status AS rep_status, "
    "r.amount AS rep_amount FROM s FULL JOIN r ON s.k = r.k",
    "s AS (SELECT k, status, amount FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts_ms DESC, pos DESC) "
    "AS rn FROM log) WHERE rn = 1 AND op <> 'd'), r AS (SELECT k, status, amount FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY k ORDER BY ts_ms DESC, pos DESC) AS rn FROM log WHERE batch_id <= {commit_sql(RECONCILED_UPTO)}) "
    "WHERE rn = 1 AND op <> 'd')"))
def q_reconcile(spark, sf):
    """Source (current truth) vs a replica that has applied commits up to N."""
    source = fold.latest_by_rank(event_log(spark, sf), "k")
    upto = commit_at(spark, sf, RECONCILED_UPTO)
    replica = versions.as_of_version(event_log(spark, sf, upto_batch=upto), "k", upto)
    return analytics.reconcile(source, replica, "k", ["status", "amount"])


@register("fk_orphans",
          "SELECT 'orders' AS child, 'o_custkey' AS fk, o_custkey AS fk_value FROM orders WHERE o_custkey IS NOT NULL "
          "AND o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL "
          "SELECT 'lineitem', 'l_orderkey', l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN "
          "(SELECT o_orderkey FROM orders) UNION ALL "
          "SELECT 'lineitem', 'l_partkey', l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN "
          "(SELECT p_partkey FROM part) UNION ALL "
          "SELECT 'events', 'user_id', user_id FROM events WHERE user_id IS NOT NULL AND user_id NOT IN "
          "(SELECT c_custkey FROM customer)")
def q_fk_orphans(spark, sf):
    def orph(child, fk, parent, pk):
        c = _t(spark, sf, child, [fk])
        p = _t(spark, sf, parent, [pk])
        return analytics.orphans(c, fk, p, pk).select(F.lit(child).alias("child"), F.lit(fk).alias("fk"),
                                                      F.col(fk).cast("long").alias("fk_value"))
    return (orph("orders", "o_custkey", "customer", "c_custkey")
            .unionByName(orph("lineitem", "l_orderkey", "orders", "o_orderkey"))
            .unionByName(orph("lineitem", "l_partkey", "part", "p_partkey"))
            .unionByName(orph("events", "user_id", "customer", "c_custkey")))


@register("fk_orphans_replica",
          "SELECT 'orders' AS child, 'o_custkey' AS fk, o_custkey AS fk_value FROM orders WHERE o_custkey IS NOT NULL "
          "AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)")
def q_fk_orphans_replica(spark, sf):
    """Orders whose customer hasn't reached the replica: every tenth customer is still missing there."""
    orders, replica = _t(spark, sf, "orders", ["o_custkey"]), _t(spark, sf, "customer", ["c_custkey"]).filter("c_custkey % 10 <> 0")
    return analytics.orphans(orders, "o_custkey", replica, "c_custkey").select(
        F.lit("orders").alias("child"), F.lit("o_custkey").alias("fk"), F.col("o_custkey").cast("long").alias("fk_value"))


@register("kpi_counts",
          "SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL "
          "SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def q_kpi_counts(spark, sf):
    return analytics.kpi_counts({n: _t(spark, sf, n) for n in ("customer", "orders", "part")})


@register("orders_by_status", "SELECT o_orderstatus, count(*) AS total FROM orders GROUP BY o_orderstatus")
def q_orders_by_status(spark, sf):
    return analytics.count_by(_t(spark, sf, "orders", ["o_orderstatus"]), "o_orderstatus")


@register("customers_by_tier", "SELECT c_mktsegment, count(*) AS total FROM customer GROUP BY c_mktsegment")
def q_customers_by_tier(spark, sf):
    return analytics.count_by(_t(spark, sf, "customer", ["c_mktsegment"]), "c_mktsegment")


@register("order_total_rollup",
          "SELECT o.o_orderkey, o.o_totalprice, i.items_total, i.n_items FROM orders o JOIN ("
          "SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))) "
          "AS DECIMAL(20,2)) AS items_total, count(*) AS n_items FROM lineitem GROUP BY l_orderkey) i "
          "ON i.l_orderkey = o.o_orderkey")
def q_order_total_rollup(spark, sf):
    items = _t(spark, sf, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice"])
    t = analytics.order_totals(items, "l_orderkey", "l_quantity", "l_extendedprice")
    o = _t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return o.join(t, o.o_orderkey == t.l_orderkey).select("o_orderkey", "o_totalprice", "items_total", "n_items")


@register("top_orders", f"SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders "
                        f"ORDER BY o_orderkey DESC LIMIT {TOP_N}")
def q_top_orders(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"])
    return analytics.top_n(o, TOP_N, [F.col("o_orderkey").desc()])


@register("top_customers", f"SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey DESC LIMIT {TOP_N}")
def q_top_customers(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return analytics.top_n(c, TOP_N, [F.col("c_custkey").desc()])


@register("stock_levels",
          "SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_size AS stock_quantity, "
          "p_retailprice AS unit_price FROM part ORDER BY stock_quantity, product_id")
def q_stock_levels(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"])
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"), F.col("p_size").alias("stock_quantity"),
                    F.col("p_retailprice").alias("unit_price")).orderBy("stock_quantity", "product_id")


@register("seeded_sample", f"SELECT c_custkey, c_name FROM customer ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), "
                           f"c_custkey LIMIT {TOP_N}")
def q_seeded_sample(spark, sf):
    return analytics.seeded_sample(_t(spark, sf, "customer", ["c_custkey", "c_name"]), "c_custkey", TOP_N, seed=42)


@register("first_match", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P' "
                         "ORDER BY o_orderkey LIMIT 1")
def q_first_match(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    return analytics.first_match(o, F.col("o_orderstatus") == "P", "o_orderkey")


@register("derive_email", "SELECT c_custkey, lower(replace(c_name, ' ', '.')) || '.' || CAST(c_custkey AS VARCHAR) "
                          "|| '@example.com' AS email FROM customer")
def q_derive_email(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_name"])
    return c.select("c_custkey", derive_email(F.col("c_name"), F.col("c_custkey")).alias("email"))


_PHONE_SQL = ("printf('+33-6-%02d-%02d-%02d-%02d', 10 + c_custkey % 90, 10 + (c_custkey // 90) % 90, "
              "10 + c_nationkey % 90, 10 + (c_custkey // 8100) % 90)")


@register("phone_format", f"SELECT c_custkey, {_PHONE_SQL} AS phone, regexp_matches({_PHONE_SQL}, "
                          f"'{PHONE_PATTERN}') AS valid FROM customer")
def q_phone_format(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    k = F.col("c_custkey")
    ph = phone_format(F.lit(10) + k % 90, F.lit(10) + F.floor(k / 90) % 90, F.lit(10) + F.col("c_nationkey") % 90,
                      F.lit(10) + F.floor(k / 8100) % 90)
    return c.select("c_custkey", ph.alias("phone")).withColumn("valid", F.col("phone").rlike(PHONE_PATTERN))


@register("apply_defaults", with_log(
    "SELECT k AS customer_id, pos, 'bronze' AS loyalty_tier, c.committed_at_ms AS created_at_ms FROM log "
    "JOIN (SELECT batch_id, max(ts_ms) AS committed_at_ms FROM log GROUP BY batch_id) c USING (batch_id) "
    "WHERE op = 'c'"))
def q_apply_defaults(spark, sf):
    """Inserts from the log into ``customers`` without a tier or creation time
    get the column DEFAULTs (tier 'bronze', created_at = commit time)."""
    ins = versions.with_commit_time(event_log(spark, sf)).filter(F.col("op") == "c").select(
        F.col("k").alias("customer_id"), "pos", F.lit(None).cast("string").alias("loyalty_tier"),
        F.lit(None).cast("long").alias("created_at_ms"), "committed_at_ms")
    filled = dml.apply_defaults(ins, {"loyalty_tier": "bronze"})
    return filled.withColumn("created_at_ms", F.coalesce(F.col("created_at_ms"), F.col("committed_at_ms"))) \
        .drop("committed_at_ms")


@register("sku_prefix", "SELECT p_partkey, p_brand, starts_with(p_brand, 'Brand#') AS has_prefix FROM part")
def q_sku_prefix(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_brand"])
    return p.withColumn("has_prefix", F.col("p_brand").startswith("Brand#"))


@register("update_by_key", "SELECT c_custkey, CASE WHEN c_custkey = 1 THEN 'PLATINUM' ELSE c_mktsegment END "
                           "AS c_mktsegment FROM customer")
def q_update_by_key(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    return dml.update_by_key(c, "c_custkey", 1, {"c_mktsegment": "PLATINUM"})


@register("insert_rows", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer UNION ALL "
                         "SELECT 999999999, 'Test Data Science', NULL, 'gold'")
def q_insert_rows(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    new = rows(spark, T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                                    T.StructField("c_nationkey", T.IntegerType()),
                                    T.StructField("c_mktsegment", T.StringType())]),
               [(999999999, "Test Data Science", None, "gold")])
    return dml.insert_rows(c, new)


@register("cascade_delete",
          "SELECT 'orders' AS table_name, o_orderkey AS order_key, CAST(NULL AS INTEGER) AS line_number FROM orders "
          "WHERE o_orderstatus <> 'P' UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem "
          "WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def q_cascade_delete(spark, sf):
    """Delete the items of every order in status 'P', then the orders."""
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    doomed = o.filter(F.col("o_orderstatus") == "P").select("o_orderkey")
    o2, li2 = dml.cascade_delete(o, li, "o_orderkey", "l_orderkey", doomed)
    return (o2.select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("order_key"),
                      F.lit(None).cast("int").alias("line_number"))
            .unionByName(li2.select(F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("order_key"),
                                    F.col("l_linenumber").alias("line_number"))))


@register("increment_totals",
          "SELECT o.o_orderkey, CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) + coalesce(d.delta, 0) AS DECIMAL(20,2)) "
          "AS new_total FROM orders o LEFT JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(12,2)) * "
          "CAST(l_extendedprice AS DECIMAL(12,2))) AS delta FROM lineitem GROUP BY l_orderkey) d "
          "ON d.l_orderkey = o.o_orderkey")
def q_increment_totals(spark, sf):
    """``UPDATE orders SET total = total + price * qty`` for every item."""
    o = _t(spark, sf, "orders", ["o_orderkey", "o_totalprice"]).withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(20,2)"))
    items = _t(spark, sf, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice"]).select(
        F.col("l_orderkey").alias("o_orderkey"),
        (F.col("l_quantity").cast("decimal(12,2)") * F.col("l_extendedprice").cast("decimal(12,2)")).alias("d"))
    out = dml.increment_totals(o, "o_orderkey", "o_totalprice", items, "d")
    return out.select("o_orderkey", F.col("o_totalprice").alias("new_total"))


@register("guarded_update",
          "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' THEN 'F' "
          "ELSE o_orderstatus END AS o_orderstatus FROM orders")
def q_guarded_update(spark, sf):
    """Advance urgent orders to 'F', guarded by ``status != 'F'`` (never touch finished ones)."""
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    guard = (F.col("o_orderstatus") != "F") & (F.col("o_orderpriority") == "1-URGENT")
    return dml.guarded_update(o, guard, {"o_orderstatus": "F"}).select("o_orderkey", "o_orderstatus")


# -- data quality --------------------------------------------------------------

_V = "SELECT '{rule}' AS rule, '{tbl}' AS tbl, '{col}' AS col, {key} AS key, {detail} AS detail FROM {src}"


def _dq_pk(spark, sf):
    return quality.dq_pk(_t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"],
                         "lineitem")


_DQ_PK_SQL = ("SELECT 'pk_unique' AS rule, 'lineitem' AS tbl, 'l_orderkey,l_linenumber' AS col, "
              "concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS key, "
              "CAST(count(*) AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")


@register("dq_pk_unique", _DQ_PK_SQL)
def q_dq_pk_unique(spark, sf):
    return _dq_pk(spark, sf)


def _dq_unique(spark, sf):
    return quality.dq_unique(_t(spark, sf, "part", ["p_name"]), "p_name", "part")


_DQ_UNIQUE_SQL = ("SELECT 'unique' AS rule, 'part' AS tbl, 'p_name' AS col, p_name AS key, CAST(count(*) AS VARCHAR) "
                  "AS detail FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1")


@register("dq_unique", _DQ_UNIQUE_SQL)
def q_dq_unique(spark, sf):
    return _dq_unique(spark, sf)


def _dq_not_null(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return quality.dq_not_null(c, ["c_name", "c_mktsegment"], "c_custkey", "customer").unionByName(
        quality.dq_not_null(o, ["o_custkey", "o_totalprice"], "o_orderkey", "orders"))


_DQ_NN_SQL = " UNION ALL ".join(
    f"SELECT 'not_null' AS rule, '{t}' AS tbl, '{c}' AS col, CAST({k} AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS detail "
    f"FROM {t} WHERE {c} IS NULL"
    for t, k, c in [("customer", "c_custkey", "c_name"), ("customer", "c_custkey", "c_mktsegment"),
                    ("orders", "o_orderkey", "o_custkey"), ("orders", "o_orderkey", "o_totalprice")])


@register("dq_not_null", _DQ_NN_SQL)
def q_dq_not_null(spark, sf):
    return _dq_not_null(spark, sf)


# VARCHAR limits of the replicated columns mapped onto the provided tables.
_LENGTHS = [("customer", "c_custkey", "c_name", 128), ("customer", "c_custkey", "c_mktsegment", 16),
            ("part", "p_partkey", "p_name", 255), ("part", "p_partkey", "p_type", 64),
            ("orders", "o_orderkey", "o_orderpriority", 8)]


def _dq_length(spark, sf):
    parts = [quality.dq_length(_t(spark, sf, t, [k, c]), {c: n}, k, t) for t, k, c, n in _LENGTHS]
    return quality._union(parts)


_DQ_LEN_SQL = " UNION ALL ".join(
    f"SELECT 'length' AS rule, '{t}' AS tbl, '{c}' AS col, CAST({k} AS VARCHAR) AS key, "
    f"CAST(length({c}) AS VARCHAR) AS detail FROM {t} WHERE length({c}) > {n}" for t, k, c, n in _LENGTHS)


@register("dq_length", _DQ_LEN_SQL)
def q_dq_length(spark, sf):
    return _dq_length(spark, sf)


def _dq_domain(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    lg = event_log(spark, sf).select(F.col("pos"), "op")
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_returnflag"])
    return (quality.dq_domain(o, "o_orderstatus", ["F", "O", "P"], "o_orderkey", "orders")
            .unionByName(quality.dq_domain(lg, "op", list(OP_DOMAIN), "pos", "events_log"))
            .unionByName(quality.dq_domain(li, "l_returnflag", ["A", "N"], "l_orderkey", "lineitem")))


_DQ_DOMAIN_BODY = (
    "SELECT 'domain' AS rule, 'orders' AS tbl, 'o_orderstatus' AS col, CAST(o_orderkey AS VARCHAR) AS key, "
    "o_orderstatus AS detail FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P') "
    "UNION ALL SELECT 'domain', 'events_log', 'op', CAST(pos AS VARCHAR), op FROM log WHERE op IS NOT NULL AND "
    "op NOT IN ('c', 'u', 'd', 'r') UNION ALL SELECT 'domain', 'lineitem', 'l_returnflag', CAST(l_orderkey AS VARCHAR), "
    "l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N')")
_DQ_DOMAIN_SQL = with_log(_DQ_DOMAIN_BODY)


@register("dq_domain", _DQ_DOMAIN_SQL)
def q_dq_domain(spark, sf):
    return _dq_domain(spark, sf)


def _dq_range(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    p = _t(spark, sf, "part", ["p_partkey", "p_size", "p_retailprice"])
    return (quality.dq_range(c, "c_acctbal", "c_custkey", "customer", lo=0)
            .unionByName(quality.dq_range(p, "p_size", "p_partkey", "part", lo=0))
            .unionByName(quality.dq_range(p, "p_retailprice", "p_partkey", "part", lo=0, lo_inclusive=False)))


_DQ_RANGE_SQL = (
    "SELECT 'range' AS rule, 'customer' AS tbl, 'c_acctbal' AS col, CAST(c_custkey AS VARCHAR) AS key, "
    "CAST(c_acctbal AS VARCHAR) AS detail FROM customer WHERE c_acctbal < 0 UNION ALL "
    "SELECT 'range', 'part', 'p_size', CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR) FROM part WHERE p_size < 0 "
    "UNION ALL SELECT 'range', 'part', 'p_retailprice', CAST(p_partkey AS VARCHAR), CAST(p_retailprice AS VARCHAR) "
    "FROM part WHERE p_retailprice <= 0")


@register("dq_range", _DQ_RANGE_SQL)
def q_dq_range(spark, sf):
    return _dq_range(spark, sf)


def _dq_shape(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_brand"])
    return quality.dq_shape(p, "p_brand", r"^Brand#[0-9]+$", "p_partkey", "part")


@register("dq_shape", "SELECT 'shape' AS rule, 'part' AS tbl, 'p_brand' AS col, CAST(p_partkey AS VARCHAR) AS key, "
                      "p_brand AS detail FROM part WHERE p_brand IS NOT NULL AND NOT regexp_matches(p_brand, "
                      "'^Brand#[0-9]+$')")
def q_dq_shape(spark, sf):
    return _dq_shape(spark, sf)


def damaged_customers(spark, sf):
    """``customers`` with faults by key: no name, the next one's email, too long a tier, a phone of another shape, no key, a row twice."""
    c = _t(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    k = F.col("c_custkey")
    mail = F.concat(F.when(k % 19 == 0, k + 1).otherwise(k).cast("string"), F.lit("@example.com"))
    rows = c.select(F.when(k % 37 != 0, k).cast("int").alias("customer_id"), F.when(k % 17 != 0, F.col("c_name")).alias("name"), F.when(k % 23 != 0, mail).alias("email"),
                    F.when(k % 13 == 0, F.concat(F.lit("x"), k)).otherwise(F.format_string("+33-6-%02d-%02d-%02d-%02d", *[F.lit(10) + k % 90] * 4)).alias("phone"),
                    F.when(k % 29 == 0, F.repeat(F.col("c_mktsegment"), F.lit(3))).otherwise(F.col("c_mktsegment")).alias("loyalty_tier"))
    return rows.unionByName(rows.filter("customer_id % 31 = 0"))


_DC_SQL = ("dc0 AS (SELECT CASE WHEN k % 37 <> 0 THEN k END::INTEGER AS customer_id, CASE WHEN k % 17 <> 0 THEN c_name END AS name, "
           "CASE WHEN k % 23 <> 0 THEN (CASE WHEN k % 19 = 0 THEN k + 1 ELSE k END) || '@example.com' END AS email, "
           "CASE WHEN k % 13 = 0 THEN 'x' || k ELSE printf('+33-6-%02d-%02d-%02d-%02d', 10 + k % 90, 10 + k % 90, 10 + k % 90, 10 + k % 90) END AS phone, "
           "CASE WHEN k % 29 = 0 THEN repeat(c_mktsegment, 3) ELSE c_mktsegment END AS loyalty_tier FROM (SELECT c_custkey AS k, * FROM customer)), "
           "dc AS (SELECT * FROM dc0 UNION ALL SELECT * FROM dc0 WHERE customer_id % 31 = 0)")
_ROW_SQL = "SELECT '{rule}' AS rule, 'customers' AS tbl, '{col}' AS col, CAST(customer_id AS VARCHAR) AS key, {detail} AS detail FROM dc WHERE {bad}"


@register("dq_spec", f"WITH {_DC_SQL} " + " UNION ALL ".join(
    [_ROW_SQL.format(rule="not_null", col=c, detail="CAST(NULL AS VARCHAR)", bad=f"{c} IS NULL") for c in CUSTOMERS_SPEC.not_null]
    + [_ROW_SQL.format(rule="length", col=c, detail=f"CAST(length({c}) AS VARCHAR)", bad=f"length({c}) > {n}") for c, n in CUSTOMERS_SPEC.lengths.items()]
    + ["SELECT 'pk_unique', 'customers', 'customer_id', CAST(customer_id AS VARCHAR), CAST(count(*) AS VARCHAR) FROM dc GROUP BY customer_id HAVING count(*) > 1 OR customer_id IS NULL",
       "SELECT 'unique', 'customers', 'email', email, CAST(count(*) AS VARCHAR) FROM dc WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1"]))
def q_dq_spec(spark, sf):
    """Every rule that the customers' spec declares, over rows with faults of each kind."""
    return quality.check_spec(damaged_customers(spark, sf), CUSTOMERS_SPEC)


@register("dq_shape_phone", f"WITH {_DC_SQL} " + _ROW_SQL.format(
    rule="shape", col="phone", detail="phone", bad=f"phone IS NOT NULL AND NOT regexp_matches(phone, '{PHONE_PATTERN}')"))
def q_dq_shape_phone(spark, sf):
    """Phones of another shape than the pattern."""
    return quality.dq_shape(damaged_customers(spark, sf), "phone", PHONE_PATTERN, "customer_id", "customers")


_NOW = dt.datetime(2024, 2, 1, 8, 30, tzinfo=dt.timezone.utc)


@register("update_stamped", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus, "
                            "CASE WHEN o_orderstatus = 'P' THEN 1706776200000 END::BIGINT AS updated_ms FROM orders")
def q_update_stamped(spark, sf):
    """``UPDATE ... SET status = 'F', updated_at = now WHERE status = 'P'``: only the rows that it hits are stamped."""
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus"]).withColumn("updated_at", F.lit(None).cast("timestamp"))
    done = dml.guarded_update(o, F.col("o_orderstatus") == "P", {"o_orderstatus": "F"}, now=_NOW)
    return done.select("o_orderkey", "o_orderstatus", F.unix_millis("updated_at").alias("updated_ms"))


@register("dq_summary", with_log(
    "SELECT rule, tbl, col, count(*) AS violations FROM (" + " UNION ALL ".join(
        f"SELECT rule, tbl, col FROM ({s})" for s in
        [_DQ_PK_SQL, _DQ_UNIQUE_SQL, _DQ_NN_SQL, _DQ_LEN_SQL, _DQ_DOMAIN_BODY, _DQ_RANGE_SQL]) +
    ") GROUP BY rule, tbl, col"))
def q_dq_summary(spark, sf):
    """All rules at once: the row-level checks of each table run in ONE scan of
    that table (``check_rows``); key uniqueness needs its own aggregate."""
    q = quality
    per_table = {
        ("customer", "c_custkey"): [q.not_null("c_name"), q.not_null("c_mktsegment"), q.max_length("c_name", 128),
                                    q.max_length("c_mktsegment", 16), q.in_range("c_acctbal", lo=0)],
        ("orders", "o_orderkey"): [q.not_null("o_custkey"), q.not_null("o_totalprice"),
                                   q.max_length("o_orderpriority", 8), q.in_domain("o_orderstatus", ["F", "O", "P"])],
        ("part", "p_partkey"): [q.max_length("p_name", 255), q.max_length("p_type", 64), q.in_range("p_size", lo=0),
                                q.in_range("p_retailprice", lo=0, lo_inclusive=False)],
        ("lineitem", "l_orderkey"): [q.in_domain("l_returnflag", ["A", "N"])],
    }
    parts = [q.check_rows(_t(spark, sf, t), t, k, checks) for (t, k), checks in per_table.items()]
    lg = event_log(spark, sf).select("pos", "op")
    parts.append(q.check_rows(lg, "events_log", "pos", [q.in_domain("op", list(OP_DOMAIN))]))
    return q.dq_summary([_dq_pk(spark, sf), _dq_unique(spark, sf), *parts])
