"""Replicate every captured table into a warehouse: one independent streaming
query per table spec, each with its own checkpoint, quarantine and replica.

Layout under ``root`` (shared storage, e.g. an object-store bucket path):
``<table>/replica/`` (ChangeTable), ``<table>/quarantine/``, ``<table>/keys/`` (KeyIndex, where the two keys differ),
``_checkpoints/<table>/``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import envelope
from tidemark.spec import TableSpec
from tidemark.streaming.apply import start_apply
from tidemark.streaming.change_table import ChangeTable
from tidemark.streaming.key_index import KeyIndex

STATE_META = [T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
              T.StructField("pos", T.LongType())]


class Warehouse:
    """Paths and change tables of the replicated tables under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, spec: TableSpec) -> ChangeTable:
        schema = T.StructType(list(spec.typed_columns().fields) + STATE_META)
        return ChangeTable(self.spark, f"{self.root}/{spec.name}/replica", spec.key, schema)

    def key_index(self, spec: TableSpec) -> KeyIndex | None:
        return KeyIndex(self.spark, f"{self.root}/{spec.name}/keys", spec.pk, spec.key, spec.typed_columns()) if spec.two_keys else None

    def quarantine_path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}/quarantine"

    def checkpoint(self, spec: TableSpec) -> str:
        return f"{self.root}/_checkpoints/{spec.name}"

    def read(self, spec: TableSpec) -> DataFrame:
        return self.table(spec).read()

    def register_views(self, specs: Iterable[TableSpec]) -> list[str]:
        """Expose the replicas' current state as temp views named after their tables,
        so plain SQL over ``customers``, ``orders``, ... runs through ``spark.sql``."""
        names = []
        for spec in specs:
            self.read(spec).drop("op", "pos").withColumnRenamed("ts_ms", "_ts").createOrReplaceTempView(spec.name)
            names.append(spec.name)
        return names


class TypedChanges:
    """Batch -> typed changes of one table with their ``_reason``. When the business key differs from the source primary key,
    a changed key also deletes the old one, and changes that carry only the primary key
    find their key in ``index`` and in the batch itself."""

    def __init__(self, spec: TableSpec, index: KeyIndex | None = None):
        self.spec, self.index = spec, index

    def _typed(self, batch: DataFrame) -> DataFrame:
        p = envelope.parse_envelope(batch, self.spec)
        if not self.spec.two_keys:
            return envelope.project_typed(p, self.spec).withColumn("pos", F.col("offset"))
        return envelope.with_key_changes(envelope.project_typed(p, self.spec, resolve_keys=False).withColumn("pos", F.col("offset")), self.spec)

    def __call__(self, batch: DataFrame) -> DataFrame:
        t = self._typed(batch)
        return envelope.resolve_keys(t, self.spec, None) if self.spec.two_keys else t

    @contextmanager
    def epoch(self, batch: DataFrame, epoch: int, writer: str) -> Iterator[DataFrame]:
        """The typed changes of a micro-batch, kept while they are written; its new keys go to the index at the end.
        The batch's own folder of the index isn't read, so that a retry sees what its first run saw."""
        if self.index is None or not self.spec.two_keys:
            rows = self(batch).persist()
            try:
                yield rows
            finally:
                rows.unpersist()
            return
        typed = self._typed(batch).persist()
        known = self.index.lookup(typed.filter(F.col("_reason").isNull()), without=(epoch, writer)).persist()
        rows = envelope.resolve_keys(typed, self.spec, known).persist()
        try:
            yield rows
            self.index.apply(rows.filter(F.col("_reason").isNull()), known, epoch, writer=writer)
        finally:
            for kept in (rows, known, typed):
                kept.unpersist()


def typed_changes(spec: TableSpec, index: KeyIndex | None = None) -> TypedChanges:
    return TypedChanges(spec, index)


def replicate_all(wh: Warehouse, specs: Iterable[TableSpec], source: Callable[[TableSpec], DataFrame], *,
                  trigger: str | None = "5 seconds") -> dict[str, StreamingQuery]:
    """Start one apply query per spec. ``source(spec)`` returns that table's
    change stream (e.g. ``read_changes(spark, spec, max_per_trigger=...)``)."""
    out = {}
    for spec in specs:
        out[spec.name] = start_apply(source(spec), wh.table(spec), wh.checkpoint(spec),
                                     to_changes=typed_changes(spec, wh.key_index(spec)), quarantine_path=wh.quarantine_path(spec),
                                     trigger=trigger, name=f"replicate_{spec.name}")
    return out
