"""What the engine reports about every batch, kept as a table.

A listener takes each progress report as the engine sends it: rows and times of the batch, state, watermark and, per
partition of a topic, how far the source has got and how far it could. Nothing is counted again and no query has to ask.
Reports go to a merged table, whose folders stay few however long the queries run.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.alerts import backpressure
from ..sinks.merged import MergedTable
from .runtime import topic_offsets

REPORT = (
    "query string, name string, batch bigint, at timestamp, rows bigint, rows_per_s double, batch_ms bigint, state_rows bigint, "
    "late_rows bigint, watermark timestamp, partitions array<struct<topic:string,partition:int,end_offset:bigint,current_offset:bigint>>"
)


def _time(text: str | None):
    from datetime import datetime

    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


def report_row(progress: dict) -> tuple:
    """A progress report as a row of ``REPORT``."""
    state = progress.get("stateOperators") or []
    rate = progress.get("processedRowsPerSecond")
    return (
        progress["id"], progress.get("name"), progress["batchId"], _time(progress.get("timestamp")), progress.get("numInputRows"),
        float(rate) if isinstance(rate, (int, float)) else None, (progress.get("durationMs") or {}).get("triggerExecution"),
        sum(s.get("numRowsTotal", 0) for s in state), sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
        _time((progress.get("eventTime") or {}).get("watermark")), topic_offsets(progress),
    )


class ProgressTable(StreamingQueryListener):
    """Listener that writes the reports of all queries below ``root``; the newest one per query and batch counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, MergedTable(root, ["query", "batch"], ("at",))
        self.lock, self.error = threading.Lock(), None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self.add(json.loads(event.progress.json))
        except Exception as error:  # the engine would only log it
            self.error = error

    def add(self, *reports: dict) -> None:
        with self.lock:
            rows = self.spark.createDataFrame([report_row(p) for p in reports], REPORT).coalesce(1)
            self.table.put(rows, self.table.through(self.spark) + 1)

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per query and batch."""
        if self.error:
            raise self.error
        return self.table.read(spark)

    def wait_for_batch(self, query: StreamingQuery, batch: int, seconds: float = 60) -> None:
        """Until the report of a batch has come, which may be after the batch has ended."""
        until = time.monotonic() + seconds
        while True:
            if self.error:
                raise self.error
            if self.table.through(self.spark) >= 0 and self.table.read(self.spark).where((F.col("query") == str(query.id)) & (F.col("batch") >= batch)).count():
                return
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {batch} after {seconds} s")
            time.sleep(0.2)


@contextmanager
def listening(spark: SparkSession, listener: StreamingQueryListener) -> Iterator[None]:
    spark.streams.addListener(listener)
    try:
        yield
    finally:
        spark.streams.removeListener(listener)


def lag(reports: DataFrame) -> DataFrame:
    """Unread messages per topic partition and batch."""
    each = reports.select("query", "batch", "at", F.explode("partitions").alias("p")).select("query", "batch", "at", "p.*")
    return each.withColumn("lag", F.col("end_offset") - F.col("current_offset"))


def backpressure_by_batch(reports: DataFrame) -> DataFrame:
    """Share of unread messages and its alert, per query, batch and topic."""
    return backpressure(lag(reports).drop("lag"), ("query", "batch", "topic"))
