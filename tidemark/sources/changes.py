"""Change-stream sources.

``read_changes`` yields rows shaped like a Kafka record
(``key, value, topic, partition, offset, timestamp``) from Kafka when the
connector is on the classpath, or from JSON/Parquet files with the same
columns (the offline twin; the Kafka jar is not part of this environment).

``to_envelopes`` goes the other way: it turns a typed change log into JSON
change envelopes, which is how tests and the derived test stream are built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import TableSpec

# Envelope as produced by the capture connector with the schemaless JSON
# converter: both row images are string maps, ``source.table`` names the table.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("before", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("after", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("source", T.StructType([
        T.StructField("table", T.StringType(), True),
        T.StructField("lsn", T.LongType(), True),
        T.StructField("ts_ms", T.LongType(), True),
    ]), True),
    T.StructField("op", T.StringType(), True),
    T.StructField("ts_ms", T.LongType(), True),
])

RAW_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])


def read_changes(spark: SparkSession, spec: TableSpec | None = None, *, mode: str = "stream",
                 fmt: str = "kafka", path: str | None = None, servers: str | None = None,
                 start: str = "earliest", fail_on_loss: bool = True,
                 max_per_trigger: int | None = None, topics: list[str] | None = None) -> DataFrame:
    """Scan a change topic (streaming or batch).

    * ``start``: ``earliest`` / ``latest`` (Kafka ``startingOffsets``).
    * ``fail_on_loss``: fail when offsets were aged out (default: fail; a lost
      change must never pass silently).
    * ``max_per_trigger``: admission control per micro-batch
      (``maxOffsetsPerTrigger`` for Kafka, ``maxFilesPerTrigger`` for files).
    """
    topic_list = topics or ([spec.topic] if spec is not None else None)
    if fmt == "kafka":
        reader = spark.readStream if mode == "stream" else spark.read
        reader = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("subscribe", ",".join(topic_list or []))
                  .option("startingOffsets", start)
                  .option("failOnDataLoss", str(fail_on_loss).lower()))
        if max_per_trigger and mode == "stream":
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        df = reader.load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", "timestamp")
    else:
        if path is None:
            raise ValueError("file change sources need a path")
        if start != "earliest" or not fail_on_loss:
            raise ValueError("a file source reads every file from the first on and misses none: start and fail_on_loss are Kafka's")
        if mode == "stream":
            reader = spark.readStream.format(fmt).schema(RAW_SCHEMA)
            if max_per_trigger:
                reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
            df = reader.load(path)
        else:
            df = spark.read.format(fmt).schema(RAW_SCHEMA).load(path)
    if topic_list:
        df = df.filter(F.col("topic").isin(topic_list))
    return df


def _image(cols: list[str]) -> Column:
    """A string map of the given columns (a row image as the converter writes it)."""
    pairs = []
    for c in cols:
        pairs += [F.lit(c), F.col(c).cast("string")]
    return F.create_map(*pairs)


def to_envelopes(log: DataFrame, spec: TableSpec, *, partitions: int = 4) -> DataFrame:
    """Typed change log -> Kafka-shaped rows carrying JSON change envelopes.

    ``c``/``u``/``r`` carry the full ``after`` image; ``u`` carries a key-only
    ``before`` (partial image); ``d`` carries the full ``before`` and a NULL
    ``after``. The Kafka partition is a hash of the key, so all changes of a key
    share a partition and ``offset`` orders them (here ``pos``).
    """
    cols = spec.names
    key_only = F.create_map(F.lit(spec.key), F.col(spec.key).cast("string"))
    after = F.when(F.col("op") != "d", _image(cols))
    before = (F.when(F.col("op") == "d", _image(cols))
              .when(F.col("op") == "u", key_only))
    env = F.struct(before.alias("before"), after.alias("after"),
                   F.struct(F.lit(spec.name).alias("table"), F.col("pos").alias("lsn"),
                            F.col("ts_ms").alias("ts_ms")).alias("source"),
                   F.col("op").alias("op"), F.col("ts_ms").alias("ts_ms"))
    return log.select(
        F.col(spec.key).cast("string").alias("key"),
        F.to_json(env).alias("value"),
        F.lit(spec.topic).alias("topic"),
        F.pmod(F.xxhash64(F.col(spec.key).cast("string")), F.lit(partitions)).cast("int").alias("partition"),
        F.col("pos").cast("long").alias("offset"),
        F.timestamp_millis(F.col("ts_ms")).alias("timestamp"),
    )
