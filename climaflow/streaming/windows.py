"""Windowed aggregates as streams, and the parameter trials over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.latest import latest_per_key
from ..operators.windows import TRIAL_MEASURES, WindowSpec, windowed_aggregate
from ..sinks.merged import MergedTable
from .runtime import METRIC_SCHEMA, Metered, batch_folders, each_batch, interval, newest_batch, run_available, run_until_read


def complete_result(spark: SparkSession, readings: DataFrame, spec: WindowSpec, root: str) -> DataFrame:
    """All windows after the available input, rewritten by each batch."""
    out = f"{root}/out"
    writer = each_batch(windowed_aggregate(readings, spec), batch_folders(out), f"{root}/checkpoint", "complete")
    return newest_batch(spark, out, run_available(writer, spark))


def run_updates(spark: SparkSession, readings: DataFrame, spec: WindowSpec, root: str):
    """Process the available input in update mode, one folder of changed windows per batch."""
    writer = each_batch(windowed_aggregate(readings, spec), batch_folders(f"{root}/out"), f"{root}/checkpoint", "update")
    return run_available(writer, spark)


def update_revisions(spark: SparkSession, root: str) -> DataFrame:
    """Every revision of every window, with the batch that wrote it."""
    return spark.read.parquet(f"{root}/out")


def update_result(spark: SparkSession, spec: WindowSpec, root: str) -> DataFrame:
    """One row per window: its newest revision."""
    keys = ["window_start", "window_end", *spec.keys]
    return latest_per_key(update_revisions(spark, root), keys, "batch_id").drop("batch_id")


def current_windows(spec: WindowSpec, root: str) -> MergedTable:
    """The newest revision of every window, in a number of folders that does not grow with the batches."""
    return MergedTable(f"{root}/current", ["window_start", "window_end", *spec.keys])


def run_current(spark: SparkSession, readings: DataFrame, spec: WindowSpec, root: str):
    """Process the available input in update mode; only the newest revision of a window is kept."""
    writer = each_batch(windowed_aggregate(readings, spec), current_windows(spec, root), f"{root}/checkpoint", "update")
    return run_available(writer, spark)


def run_closed(spark: SparkSession, readings: DataFrame, spec: WindowSpec, root: str):
    """Append mode: a window is written once, when the watermark has passed its end."""
    stream = windowed_aggregate(readings, spec)
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    )
    return run_available(writer, spark)


@dataclass(frozen=True)
class Trial:
    number: int
    trigger: str
    watermark: str
    window: str


# The three parameter trials.
TRIALS = (
    Trial(1, "10 seconds", "1 minute", "5 minutes"),
    Trial(2, "30 seconds", "2 minutes", "5 minutes"),
    Trial(3, "60 seconds", "5 minutes", "10 minutes"),
)


def run_trial(spark: SparkSession, readings: DataFrame, trial: Trial, root: str, speedup: float = 1.0) -> DataFrame:
    """One trial over the input that is there, a batch at each of its triggers; result rows, seconds and rows per second of
    every batch. ``speedup`` shortens the time between triggers."""
    spec = WindowSpec(trial.window, trial.watermark, ("hour_of_day",), TRIAL_MEASURES)
    here = f"{root}/trial-{trial.number}"
    metered = Metered(batch_folders(f"{here}/out"), f"{here}/metrics", trial.number)
    writer = each_batch(windowed_aggregate(readings, spec), metered, f"{here}/checkpoint", "update")
    run_until_read(writer, spark, interval(trial.trigger, speedup))
    return spark.read.schema(METRIC_SCHEMA).parquet(f"{here}/metrics").drop("batch_id")


def compare_trials(spark: SparkSession, readings: DataFrame, root: str, trials=TRIALS, speedup: float = 1.0) -> DataFrame:
    """Batches, result rows, mean latency and throughput of each trial."""
    metrics = spark.createDataFrame([], METRIC_SCHEMA)
    for t in trials:
        metrics = metrics.unionByName(run_trial(spark, readings, t, root, speedup))
    settings = spark.createDataFrame(
        [(t.number, t.trigger, t.watermark, t.window) for t in trials],
        "trial int, trigger string, watermark string, window_width string",
    )
    by_trial = metrics.groupBy("trial").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("rows"),
        F.round(F.avg("latency_s"), 3).alias("mean_latency_s"),
        F.round(F.sum("rows") / F.greatest(F.sum("latency_s"), F.lit(0.001)), 2).alias("throughput"),
    )
    return settings.join(by_trial, "trial", "left")
