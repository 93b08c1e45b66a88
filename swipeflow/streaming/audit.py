"""Audit rows of a stream (B14 / J2): one appended row per micro-batch.

The stream counts its rows and failed rows while it writes them (``observe``); a query listener gets the
counts with the batch's progress and hands a row to a writer thread, which appends all rows that wait to the audit table. So
a listener never holds up the listener bus with a Spark job, however many micro-batches there are. A stream that ends with an error leaves a
FAILED row. Batches report at least once (a batch repeated after a crash reports again), so ``read_audit`` keeps the
last report of every batch.
"""

from __future__ import annotations

import queue
import threading
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions import columns as C

METRIC = "audit"
SCHEMA = "query_id string, run_id string, pipeline_name string, batch_id long, batch_start string, duration_ms long, rows_processed long, rows_failed long, status string, error_message string, reported_at timestamp"


def counted(stream: DataFrame, failed: Column) -> DataFrame:
    """``stream`` with the counts that ``StreamAudit`` reports."""
    return stream.observe(METRIC, F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("failed"))


class StreamAudit(StreamingQueryListener):
    """Appends a row per micro-batch of the query ``name`` to the Parquet table at ``path``; ``close`` waits for the last."""

    def __init__(self, spark: SparkSession, path: str, name: str, pipeline: str) -> None:
        self.spark, self.path, self.name, self.pipeline = spark, path, name, pipeline
        self.mine: set[str] = set()
        self.waiting: queue.SimpleQueue = queue.SimpleQueue()
        self.writer: threading.Thread | None = None
        self.error: Exception | None = None

    def append(self, *row) -> None:
        self._write([(*row, datetime.now(timezone.utc))])

    def _write(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def report(self, *row) -> None:
        """Leaves a row to the writer."""
        if self.writer is None:
            self.writer = threading.Thread(target=self._run, daemon=True)
            self.writer.start()
        self.waiting.put((*row, datetime.now(timezone.utc)))

    def _run(self) -> None:
        open_ = True
        while open_:
            rows = [self.waiting.get()]
            while not self.waiting.empty():
                rows.append(self.waiting.get())
            open_ = None not in rows
            try:
                if rows := [r for r in rows if r is not None]:
                    self._write(rows)
            except Exception as e:
                self.error = self.error or e

    def close(self) -> None:
        """Waits until every reported row is in the table; an error of the writer is the caller's."""
        if self.writer is not None:
            self.waiting.put(None)
            self.writer.join()
            self.writer = None
        if self.error:
            raise self.error

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.mine.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or not p.numInputRows:
            return  # another query, or a trigger without data
        counts = p.observedMetrics.get(METRIC)
        rows, failed = (counts["rows"], counts["failed"]) if counts is not None else (p.numInputRows, None)
        status = "SUCCESS" if not failed else "PARTIAL"
        self.report(str(p.id), str(p.runId), self.pipeline, p.batchId, p.timestamp, p.durationMs.get("triggerExecution"), rows, failed, status, None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception and str(event.runId) in self.mine:
            self.report(str(event.id), str(event.runId), self.pipeline, None, None, None, None, None, "FAILED", event.exception[:2000])


def run_audited(spark: SparkSession, start, path: str, name: str, pipeline: str) -> None:
    """Run the query that ``start()`` starts under ``name`` to its end, with its audit rows appended to ``path``."""
    listener = StreamAudit(spark, path, name, pipeline)
    spark.streams.addListener(listener)
    try:
        try:
            start().awaitTermination()
        finally:
            # reports arrive on the listener bus, after the batch
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(600_000)
    finally:
        spark.streams.removeListener(listener)
        listener.close()


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The last report of every batch, and all failures."""
    rows = spark.read.parquet(path)
    last = Window.partitionBy("query_id", "batch_id", "status").orderBy(F.desc("reported_at"))
    ranked = rows.withColumn("_n", F.row_number().over(last)).filter((F.col("_n") == 1) | F.col("batch_id").isNull())
    pass_rate = C.rate_pct("rows_processed - rows_failed", "rows_processed", 2).cast("decimal(6,2)")
    return ranked.drop("_n").withColumn("dq_pass_rate_pct", pass_rate)
