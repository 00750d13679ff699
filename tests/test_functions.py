import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import scalar


def test_time_conversions_are_time_zone_free(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 12, 0, 0, 123456),)], "ts timestamp_ntz")
    r = df.select(scalar.ms_from_ntz(F.col("ts")).alias("ms")).first()
    assert r.ms == 1705320000123
    back = spark.createDataFrame([(1705320000123,), (None,)], "ms long").select(
        scalar.event_time(F.col("ms")).alias("t"), scalar.format_instant(F.col("ms")).alias("s")).collect()
    assert back[0].t == dt.datetime(2024, 1, 15, 12, 0, 0, 123000) and back[0].s == "2024-01-15 12:00:00"
    assert back[1].t is None
    m = spark.range(1).select(scalar.minutes_before(F.lit(1_800_000), 30).alias("m")).first().m
    assert m == 0


def test_string_builders_and_json(spark):
    df = spark.createDataFrame([("Ada Test", 9, '{"k": 7}'), ("Bo Sample", 14, "{bad")],
                               "name string, id long, props string")
    rows = df.select(scalar.derive_email(F.col("name"), F.col("id")).alias("e"),
                     scalar.phone_format(F.lit(12), F.lit(34), F.lit(5), F.lit(78)).alias("p"),
                     scalar.json_field(F.col("props"), "$.k", "int").alias("k")).collect()
    assert rows[0].e == "ada.test.9@example.com" and rows[0].p == "+33-6-12-34-05-78" and rows[0].k == 7
    assert rows[1].k is None                       # malformed JSON -> NULL, not a failure
