"""Starting, finishing and measuring streaming queries."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

METRIC_SCHEMA = T.StructType([
    T.StructField("trial", T.IntegerType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("latency_s", T.DoubleType()),
    T.StructField("throughput", T.DoubleType()),
])


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Session settings that a stateful query takes over when it starts.

    The number of state partitions is fixed by the first start on a checkpoint. Unless given, it
    is the session's shuffle width, but at most twice the cores. State lives in RocksDB, so it may
    outgrow executor memory.
    """
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = partitions or min(width, 2 * spark.sparkContext.defaultParallelism)
    wanted = {
        "spark.sql.shuffle.partitions": str(chosen),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_available(writer: DataStreamWriter, spark: SparkSession, partitions: int | None = None) -> StreamingQuery:
    """Process all input that is there, then stop. Raises what the query raised."""
    with state_settings(spark, partitions):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def start_every(writer: DataStreamWriter, spark: SparkSession, interval: str, partitions: int | None = None) -> StreamingQuery:
    """Start with a processing-time trigger (5, 10, 30 or 60 seconds in the usual set-ups)."""
    with state_settings(spark, partitions):
        return writer.trigger(processingTime=interval).start()


def interval(trigger: str, speedup: float = 1.0) -> str:
    """A trigger of whole seconds, such as ``10 seconds``, in milliseconds; ``speedup`` times as fast."""
    number, unit = trigger.split()
    if unit not in ("second", "seconds"):
        raise ValueError(f"not a number of seconds: {trigger}")
    return f"{max(1, round(int(number) * 1000 / speedup))} milliseconds"


def run_until_read(writer: DataStreamWriter, spark: SparkSession, every: str, partitions: int | None = None) -> StreamingQuery:
    """Batches at a processing-time trigger until all input that is there has been read. Raises what the query raised."""
    query = start_every(writer, spark, every, partitions)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def console_writer(df: DataFrame, checkpoint: str, rows: int = 50) -> DataStreamWriter:
    """Changed rows to the console, uncut."""
    return (
        df.writeStream.format("console").outputMode("update")
        .option("truncate", False).option("numRows", rows)
        .option("checkpointLocation", checkpoint)
    )


def memory_writer(df: DataFrame, name: str, mode: str = "update") -> DataStreamWriter:
    """Named in-memory table for ad-hoc SQL.

    The table lives on the driver: for small results only. In update mode it holds every revision
    of a window; see ``latest_per_key``.
    """
    return df.writeStream.format("memory").queryName(name).outputMode(mode)


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> DataStreamWriter:
    return df.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)


def batch_folders(path: str) -> Callable[[DataFrame, int], None]:
    """Batch callback that keeps each batch in its own folder; a replayed batch replaces its own."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return save


def newest_batch(spark: SparkSession, path: str, query: StreamingQuery) -> DataFrame:
    """The folder of the query's last batch (complete-mode output)."""
    return spark.read.parquet(f"{path}/batch_id={last_batch_id(query)}")


def last_batch_id(query: StreamingQuery) -> int:
    return query.lastProgress["batchId"]


def metrics_frame(spark: SparkSession, metrics: list[tuple]) -> DataFrame:
    return spark.createDataFrame(metrics, METRIC_SCHEMA)


class Metered:
    """Batch callback that runs another one and records rows, seconds and rows per second.

    The count fills the cache that the inner callback then reads, so the batch's source is read
    once.
    """

    def __init__(self, inner: Callable[[DataFrame, int], None], out: str, trial: int = 0):
        self.inner, self.out, self.trial = inner, out, trial

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        began = time.time()
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = kept.count()
            self.inner(kept, batch_id)
        finally:
            kept.unpersist()
        seconds = round(time.time() - began, 3)
        metric = (self.trial, batch_id, rows, seconds, round(rows / max(seconds, 0.001), 2))
        frame = metrics_frame(batch.sparkSession, [metric]).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.out}/batch_id={batch_id}")


def topic_offsets(progress: dict) -> list[tuple]:
    """Rows ``topic, partition, end_offset, current_offset`` of the Kafka sources in a progress report."""
    found = []
    for source in progress.get("sources", []):
        newest, reached = (
            json.loads(v) if isinstance(v := source.get(k) or "{}", str) else v for k in ("latestOffset", "endOffset")
        )
        for topic, partitions in newest.items():
            for partition, end in partitions.items():
                found.append((topic, int(partition), int(end), int(reached.get(topic, {}).get(partition, 0))))
    return found


def offsets_frame(spark: SparkSession, progress: dict) -> DataFrame:
    return spark.createDataFrame(
        topic_offsets(progress), "topic string, partition int, end_offset bigint, current_offset bigint"
    )
