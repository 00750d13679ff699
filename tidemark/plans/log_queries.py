"""Queries over change envelopes and the multi-table change log: parsing,
quarantine, typing, routing, audit, rates, lag and monitoring (SURVEY §2 A,
B1-B4, D4, D8-D10, H2, H6, J15-J16, K11, M, N10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import event_time, json_field, ms_from_ntz
from tidemark.operators import analytics, envelope, monitor, quality, versions
from tidemark.plans.registry import register
from tidemark.plans.testdata import commit_at, commit_sql, event_log, table, with_log
from tidemark.session import spread, work_dir
from tidemark.sources.changes import to_envelopes
from tidemark.spec import EVENTS_SPEC

# Fixed parameters of the registered queries.
CONSUMER_POSITION = 80        # last commit the consumer has acknowledged, in hundredths of the log's commits
SCHEMA_CHANGE_AT = 60         # commit from which row images carry a new column, likewise
_POSITION_SQL, _CHANGE_SQL = commit_sql(CONSUMER_POSITION), commit_sql(SCHEMA_CHANGE_AT)
SLA_MS = 60_000
HEARTBEATS = "__heartbeat.cdc"


def envelopes(spark, sf, corrupt: bool = False):
    """Kafka-shaped JSON envelopes built from the derived log. With
    ``corrupt``, every record whose offset is a multiple of 97 is truncated by 3
    characters (a deterministic stand-in for damaged records)."""
    raw = to_envelopes(spread(event_log(spark, sf), spark.sparkContext.defaultParallelism), EVENTS_SPEC)
    if corrupt:
        raw = raw.withColumn("value", F.when(F.col("offset") % 97 == 0,
                                             F.expr("substring(value, 1, length(value) - 3)"))
                             .otherwise(F.col("value")))
    return raw


@register("parse_envelope", with_log(
    "SELECT 'events' AS source_table, CAST(k AS VARCHAR) AS key, op, ts_ms, pos AS \"offset\" FROM log"))
def q_parse_envelope(spark, sf):
    p = envelope.parse_envelope(envelopes(spark, sf), EVENTS_SPEC, drop_tombstones=False)
    return p.select(F.col("table").alias("source_table"), "key", "op", "ts_ms", "offset")


@register("parse_quarantine", with_log(
    "SELECT CASE WHEN pos % 97 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS key, "
    "CASE WHEN pos % 97 = 0 THEN NULL ELSE op END AS op, CASE WHEN pos % 97 = 0 THEN NULL ELSE ts_ms END AS ts_ms, "
    "pos AS \"offset\", CASE WHEN pos % 97 = 0 THEN 'malformed' ELSE 'ok' END AS reason FROM log"))
def q_parse_quarantine(spark, sf):
    """Every record comes out: valid ones with ``ok``, damaged ones with their
    quarantine reason (nothing is silently dropped)."""
    p = envelope.parse_envelope(envelopes(spark, sf, corrupt=True), EVENTS_SPEC, drop_tombstones=False)
    return p.select("key", "op", "ts_ms", "offset", F.coalesce("_reason", F.lit("ok")).alias("reason"))


def damaged(spark, sf):
    """Records with one kind of damage each, by offset: a field that is replaced in the text, a tombstone, a heartbeat."""
    raw = to_envelopes(spread(event_log(spark, sf), spark.sparkContext.defaultParallelism), EVENTS_SPEC)
    kind, put = F.col("offset") % 23, lambda pattern, to: F.regexp_replace("value", pattern, to)
    value = (F.when(kind == 1, F.expr("substring(value, 1, length(value) - 3)"))
             .when(kind == 2, put('"op":"."', '"op":"x"')).when(kind == 3, put(',"op":"."', ""))
             .when(kind == 4, put('"op":("."),"ts_ms":[0-9]+', '"op":$1,"ts_ms":null'))
             .when(kind == 5, put('"table":"events"', '"table":"others"'))
             .when(kind == 6, put('"k":"[0-9]+",?', ""))
             .when(kind == 7, put('"status":"[a-z]+",?', ""))
             .when(kind == 8, put('"before":', '"was":'))
             .when(kind == 9, F.lit(None)).when(kind == 10, F.lit("")).when(kind == 11, F.lit("[1, 2]"))
             .when(kind == 12, put('"amount":"[^"]*"', '"amount":"much"'))
             .otherwise(F.col("value")))
    return raw.select("key", value.alias("value"), F.when(kind == 13, F.lit(HEARTBEATS)).otherwise(F.col("topic")).alias("topic"), "partition", "offset", "timestamp")


# Kinds 9, 10 and 13 are no changes; a lost "before" (8) costs deletes their key.
_DAMAGED = "d AS (SELECT *, pos % 23 AS kind FROM log WHERE pos % 23 NOT IN (9, 10, 13))"


@register("quarantine_reasons", with_log(
    "SELECT pos AS \"offset\", CASE WHEN kind IN (1, 11) THEN 'malformed' WHEN kind IN (2, 3) THEN 'bad_op' WHEN kind = 4 THEN 'bad_ts' "
    "WHEN kind = 5 THEN 'unknown_table' WHEN kind = 6 OR (kind = 8 AND op = 'd') THEN 'no_key' WHEN kind = 12 AND amount IS NOT NULL THEN 'bad_cast:amount' ELSE 'ok' END AS reason FROM d", _DAMAGED))
def q_quarantine_reasons(spark, sf):
    """Every reason for quarantine, from one parse; tombstones and heartbeats are no changes and don't come out."""
    p = envelope.parse_envelope(damaged(spark, sf), EVENTS_SPEC, heartbeat_topics=[HEARTBEATS])
    return envelope.project_typed(p, EVENTS_SPEC).select("offset", F.coalesce("_reason", F.lit("ok")).alias("reason"))


@register("dq_image_rules", with_log(
    "SELECT * FROM (SELECT 'images' AS rule, 'events' AS tbl, 'op' AS col, CASE WHEN kind IN (1, 6, 11) OR (kind = 8 AND op = 'd') THEN 'NULL' ELSE CAST(k AS VARCHAR) END AS key, "
    "CASE WHEN kind IN (1, 2, 3, 11) THEN 'op_domain' WHEN kind IN (6, 7) AND op = 'c' THEN 'insert_missing_columns' "
    "WHEN kind = 8 AND op = 'u' THEN 'update_missing_image' WHEN kind IN (6, 8) AND op = 'd' THEN 'delete_without_key' END AS detail FROM d) WHERE detail IS NOT NULL", _DAMAGED))
def q_dq_image_rules(spark, sf):
    """Every rule on row images: inserts without a column, updates without an image, deletes without a key, unknown ops."""
    return quality.dq_images(envelope.parse_envelope(damaged(spark, sf), EVENTS_SPEC, heartbeat_topics=[HEARTBEATS]), EVENTS_SPEC)


@register("typed_projection", with_log("SELECT k, status, amount, op, ts_ms, pos FROM log"))
def q_typed_projection(spark, sf):
    p = envelope.parse_envelope(envelopes(spark, sf), EVENTS_SPEC, drop_tombstones=False)
    t = envelope.project_typed(p, EVENTS_SPEC)
    return t.filter(F.col("_reason").isNull()).select("k", "status", "amount", "op", "ts_ms",
                                                      F.col("offset").alias("pos"))


def multi_table_log(spark, sf):
    """Changes of three captured tables in one log: customer and order
    snapshots (op 'r') and the event change stream."""
    c = table(spark, sf, "customer", ["c_custkey"]).select(
        F.lit("customers").alias("table_name"), F.col("c_custkey").cast("string").alias("key"),
        F.lit("r").alias("op"), F.lit(0).cast("long").alias("ts_ms"))
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderdate"]).select(
        F.lit("orders").alias("table_name"), F.col("o_orderkey").cast("string").alias("key"),
        F.lit("r").alias("op"), ms_from_ntz(F.col("o_orderdate")).alias("ts_ms"))
    e = event_log(spark, sf).select(F.lit("events").alias("table_name"), F.col("k").cast("string").alias("key"),
                                    "op", "ts_ms")
    return c.unionByName(o).unionByName(e)


_MULTI_SQL = ("m AS (SELECT 'customers' AS table_name, CAST(c_custkey AS VARCHAR) AS key, 'r' AS op, "
              "CAST(0 AS BIGINT) AS ts_ms FROM customer UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), 'r', "
              "epoch_us(o_orderdate) // 1000 FROM orders UNION ALL SELECT 'events', CAST(k AS VARCHAR), op, ts_ms FROM log)")


@register("route_by_table", with_log("SELECT * FROM m WHERE table_name IN ('customers', 'events')", _MULTI_SQL))
def q_route_by_table(spark, sf):
    return envelope.route(multi_table_log(spark, sf), ["customers", "events"], col="table_name")


@register("changes_by_op", with_log("SELECT table_name, op, count(*) AS n_changes FROM m GROUP BY table_name, op",
                                    _MULTI_SQL))
def q_changes_by_op(spark, sf):
    return analytics.changes_by_op(multi_table_log(spark, sf), "table_name")


@register("change_audit", with_log(
    "SELECT table_name, count(*) AS change_count, min(ts_ms) AS first_event, max(ts_ms) AS last_event "
    "FROM m GROUP BY table_name", _MULTI_SQL))
def q_change_audit(spark, sf):
    return analytics.change_audit(multi_table_log(spark, sf), "table_name")


@register("change_rate_5m", with_log(
    "SELECT (ts_ms // 300000) * 300000 AS window_start_ms, op, count(*) AS n_changes, "
    "round(count(*) / 300.0, 6) AS per_second FROM log GROUP BY 1, op"))
def q_change_rate_5m(spark, sf):
    return monitor.change_rate(event_log(spark, sf), 300_000, by=["op"])


@register("change_rate_1m", with_log(
    "SELECT (ts_ms // 60000) * 60000 AS window_start_ms, status, count(*) AS n_changes, "
    "round(count(*) / 60.0, 6) AS per_second FROM log GROUP BY 1, status"))
def q_change_rate_1m(spark, sf):
    return monitor.change_rate(event_log(spark, sf), 60_000, by=["status"])


@register("sliding_rate", with_log(
    "SELECT s AS window_start_ms, s + 300000 AS window_end_ms, count(*) AS n_changes FROM ("
    "SELECT unnest(generate_series((ts_ms // 60000) * 60000 - 240000, (ts_ms // 60000) * 60000, 60000)) AS s "
    "FROM log) GROUP BY s"))
def q_sliding_rate(spark, sf):
    """5-minute windows sliding every minute."""
    return monitor.sliding_rate(event_log(spark, sf), "5 minutes", "1 minute")


@register("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_value FROM events")
def q_json_field(spark, sf):
    ev = table(spark, sf, "events", ["event_id", "props"])
    return ev.select("event_id", json_field(F.col("props"), "$.k", "bigint").alias("k_value"))


@register("event_time", with_log("SELECT pos, ts_ms, epoch_ms(ts_ms) AS event_ts FROM log"))
def q_event_time(spark, sf):
    return event_log(spark, sf).select("pos", "ts_ms", event_time(F.col("ts_ms")).alias("event_ts"))


def log_with_new_column(spark, sf):
    """Row images as string maps; from commit SCHEMA_CHANGE_AT on, the source
    adds a column ``prop_k`` (taken from the event's ``props``)."""
    j = event_log(spark, sf, extra=("props",)).withColumn("prop_k", json_field(F.col("props"), "$.k", "bigint"))
    base = F.create_map(F.lit("k"), F.col("k").cast("string"), F.lit("status"), F.col("status"),
                        F.lit("amount"), F.col("amount").cast("string"))
    extra = F.when(F.col("batch_id") >= commit_at(spark, sf, SCHEMA_CHANGE_AT),
                   F.create_map(F.lit("prop_k"), F.col("prop_k").cast("string"))) \
        .otherwise(F.create_map().cast("map<string,string>"))
    return j.withColumn("after", F.when(F.col("op") != "d", F.map_concat(base, extra)))


@register("schema_drift", with_log(
    "SELECT 'prop_k' AS column_name, count(*) AS n_changes, min(ts_ms) AS first_seen_ms, max(ts_ms) AS last_seen_ms "
    f"FROM log WHERE batch_id >= {_CHANGE_SQL} AND op <> 'd' GROUP BY column_name"))
def q_schema_drift(spark, sf):
    return versions.observed_columns(log_with_new_column(spark, sf), EVENTS_SPEC.names)


@register("schema_evolve", with_log(
    f"SELECT k, pos, status, CASE WHEN batch_id >= {_CHANGE_SQL} "
    "THEN CAST(json_extract_string(e.props, '$.k') AS BIGINT) END AS prop_k "
    "FROM log JOIN events e ON e.event_id = log.pos"))
def q_schema_evolve(spark, sf):
    """Files written before the change (old column set) read together with
    files written after it: matched by name, the new column NULL for old rows."""
    j = log_with_new_column(spark, sf)
    old = j.filter(F.col("batch_id") < commit_at(spark, sf, SCHEMA_CHANGE_AT)).select("k", "pos", "status")
    new = j.filter(F.col("batch_id") >= commit_at(spark, sf, SCHEMA_CHANGE_AT)).select("k", "pos", "status", "prop_k")
    return versions.evolve(old, new)


@register("schema_evolve_files", with_log(
    f"SELECT k, pos, CAST(CASE WHEN batch_id < {_CHANGE_SQL} THEN pos % 1000 ELSE amount END AS DECIMAL(12,2)) AS amount, "
    f"CASE WHEN batch_id >= {_CHANGE_SQL} THEN status END AS status FROM log"))
def q_schema_evolve_files(spark, sf):
    """Files of three generations read as one scan: ``k`` grew from int to long, ``amount`` from int to decimal, ``status`` came."""
    root = work_dir(spark, "generations")
    log = event_log(spark, sf)
    change, at = commit_at(spark, sf, SCHEMA_CHANGE_AT), F.col("batch_id")
    half = change // 2
    first = log.filter(at < half).select(F.col("k").cast("int"), "pos", (F.col("pos") % 1000).cast("int").alias("amount"))
    second = log.filter((at >= half) & (at < change)).select("k", "pos", (F.col("pos") % 1000).cast("decimal(12,2)").alias("amount"))
    third = log.filter(at >= change).select("k", "pos", "amount", "status")
    for n, part in enumerate((first, second, third)):
        part.write.parquet(f"{root}/{n}")
    return versions.read_generations(spark, *[f"{root}/{n}" for n in range(3)])


@register("dq_images", with_log(
    "SELECT 'images' AS rule, 'events' AS tbl, 'op' AS col, 'NULL' AS key, 'op_domain' AS detail "
    "FROM log WHERE pos % 97 = 0"))
def q_dq_images(spark, sf):
    """Envelope completeness rules over the damaged stream."""
    p = envelope.parse_envelope(envelopes(spark, sf, corrupt=True), EVENTS_SPEC, drop_tombstones=False)
    return quality.dq_images(p, EVENTS_SPEC)


@register("enrich_changes", with_log(
    "SELECT log.k, log.pos, log.op, log.status, c.c_name, c.c_mktsegment FROM log "
    "LEFT JOIN customer c ON c.c_custkey = log.k"))
def q_enrich_changes(spark, sf):
    dim = table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    e = analytics.enrich(event_log(spark, sf), dim, "k", "c_custkey", ["c_name", "c_mktsegment"])
    return e.select("k", "pos", "op", "status", "c_name", "c_mktsegment")


_C = "c AS (SELECT batch_id, max(ts_ms) AS committed_at_ms FROM log GROUP BY batch_id)"


@register("replication_lag", with_log(
    "SELECT status, count(*) AS n_changes, round(avg(committed_at_ms - ts_ms), 3) AS avg_lag_ms, "
    f"max(committed_at_ms - ts_ms) AS max_lag_ms, count(*) FILTER (WHERE committed_at_ms - ts_ms > {SLA_MS}) AS over_sla "
    "FROM log JOIN c USING (batch_id) GROUP BY status", _C))
def q_replication_lag(spark, sf):
    return monitor.replication_lag(versions.with_commit_time(event_log(spark, sf)), by=["status"], sla_ms=SLA_MS)


@register("replication_lag_percentiles", with_log(
    "SELECT status, quantile_disc(committed_at_ms - ts_ms, 0.5) AS p50, quantile_disc(committed_at_ms - ts_ms, 0.95) AS p95, "
    "quantile_disc(committed_at_ms - ts_ms, 0.99) AS p99 FROM log JOIN c USING (batch_id) GROUP BY status", _C))
def q_replication_lag_percentiles(spark, sf):
    """Exact p50, p95 and p99 of the delivery lag by status."""
    lag = versions.with_commit_time(event_log(spark, sf)).withColumn("lag_ms", F.col("committed_at_ms") - F.col("ts_ms"))
    return monitor.exact_percentiles(lag, "lag_ms", ["status"])


def kafka_log(spark, sf):
    """The log with its Kafka coordinates: 4 partitions by key, offset = pos."""
    return (event_log(spark, sf).withColumn("topic", F.lit("cdc.sales.events"))
            .withColumn("partition", F.pmod(F.col("k"), F.lit(4)).cast("int")).withColumn("offset", F.col("pos")))


def consumer_positions(spark, sf):
    """A consumer that has read all commits up to ``CONSUMER_POSITION``: its committed offset per partition."""
    return (kafka_log(spark, sf).filter(F.col("batch_id") <= commit_at(spark, sf, CONSUMER_POSITION)).groupBy("topic", "partition")
            .agg(F.max("offset").alias("committed_offset")))


@register("consumer_lag", with_log(
    "SELECT 'cdc.sales.events' AS topic, CAST(k % 4 AS INTEGER) AS partition, max(pos) AS end_offset, "
    f"max(pos) FILTER (WHERE batch_id <= {_POSITION_SQL}) AS committed_offset, "
    f"count(*) FILTER (WHERE batch_id > {_POSITION_SQL}) AS lag_messages FROM log GROUP BY 2"))
def q_consumer_lag(spark, sf):
    return monitor.consumer_lag(kafka_log(spark, sf), consumer_positions(spark, sf))


def pipeline_metrics(spark, sf):
    """``(metric, subject, value)`` rows: consumer lag per partition, batch
    duration and end-to-end lag per commit, all derived from the log."""
    log = event_log(spark, sf)
    lag = monitor.consumer_lag(kafka_log(spark, sf), consumer_positions(spark, sf)).select(
        F.lit("consumer_lag_messages").alias("metric"), F.concat(F.lit("partition-"), F.col("partition")).alias("subject"),
        F.col("lag_messages").cast("double").alias("value"))
    per_batch = versions.with_commit_time(log).groupBy("batch_id").agg(
        ((F.max("ts_ms") - F.min("ts_ms")) / 1000.0).alias("duration_s"),
        (F.max(F.col("committed_at_ms") - F.col("ts_ms")) / 1000.0).alias("e2e_s"))
    subj = F.concat(F.lit("commit-"), F.col("batch_id"))
    dur = per_batch.select(F.lit("batch_duration_s").alias("metric"), subj.alias("subject"),
                           F.round("duration_s", 3).cast("double").alias("value"))
    e2e = per_batch.select(F.lit("end_to_end_lag_s").alias("metric"), subj.alias("subject"),
                           F.round("e2e_s", 3).cast("double").alias("value"))
    return lag.unionByName(dur).unionByName(e2e)


@register("sla_breaches", with_log(
    "SELECT metric, subject, value, limit_value, true AS breach FROM ("
    f"SELECT 'consumer_lag_messages' AS metric, 'partition-' || CAST(k % 4 AS VARCHAR) AS subject, "
    f"CAST(count(*) FILTER (WHERE batch_id > {_POSITION_SQL}) AS DOUBLE) AS value FROM log GROUP BY k % 4 "
    "UNION ALL SELECT 'batch_duration_s', 'commit-' || CAST(batch_id AS VARCHAR), "
    "round((max(ts_ms) - min(ts_ms)) / 1000.0, 3) FROM log GROUP BY batch_id "
    "UNION ALL SELECT 'end_to_end_lag_s', 'commit-' || CAST(batch_id AS VARCHAR), "
    "round((max(committed_at_ms - ts_ms)) / 1000.0, 3) FROM log JOIN c USING (batch_id) GROUP BY batch_id) "
    "JOIN (VALUES ('consumer_lag_messages', CAST(10000 AS DOUBLE)), ('batch_duration_s', CAST(30 AS DOUBLE)), "
    "('end_to_end_lag_s', CAST(60 AS DOUBLE))) "
    "AS l(metric, limit_value) USING (metric) WHERE value > limit_value", _C))
def q_sla_breaches(spark, sf):
    return monitor.sla_breaches(pipeline_metrics(spark, sf), monitor.limits_frame(spark)).select(
        "metric", "subject", "value", "limit_value", "breach")
