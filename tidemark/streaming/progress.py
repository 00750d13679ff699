"""Every progress report of the session's streaming queries, kept as files that Spark reads back as a table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.streaming.storage import listed, write_text

REPORT = ("id string, runId string, name string, timestamp string, batchId long, numInputRows long, inputRowsPerSecond double, processedRowsPerSecond double, "
          "durationMs struct<triggerExecution: long>")


class ProgressLog(StreamingQueryListener):
    """A listener that writes each report to ``root`` as ``query=<id>/run=<run>/batch=<n>.json``.

    Spark itself keeps the newest few reports of a query in the driver's memory; here none is lost, whatever the
    number of micro-batches. A batch's later report (of a trigger without data) replaces its earlier one only if that had no rows either.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.ended = spark, root.rstrip("/"), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        path = f"{self.root}/query={p.id}/run={p.runId}/batch={p.batchId}.json"
        if p.numInputRows or not listed(self.spark, path):
            write_text(self.spark, path, " ".join(p.json.split()))

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def wait(self, query: StreamingQuery, timeout_s: float = 60) -> None:
        """Until all reports of an ended query are written (listeners hear of them a little later)."""
        until = time.monotonic() + timeout_s
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"query {query.id} hasn't ended")
            time.sleep(0.05)

    def frame(self) -> DataFrame:
        """query_id, run_id, batch_id, num_input_rows, the rates and trigger_ms of every report."""
        names = "id query_id, runId run_id, batchId batch_id, numInputRows num_input_rows, inputRowsPerSecond input_rows_per_second, processedRowsPerSecond processed_rows_per_second"
        read = (self.spark.read.schema(REPORT).json(f"{self.root}/*/*/*.json") if listed(self.spark, f"{self.root}/*/*/*.json")
                else self.spark.createDataFrame([], REPORT))
        return read.select(*[F.col(a).alias(b) for a, b in (n.split() for n in names.split(", "))], F.col("durationMs.triggerExecution").alias("trigger_ms"))
