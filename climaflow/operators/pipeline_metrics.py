"""Cumulative batch metrics, operating summary and recent latency."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.fixedpoint import half_up_ratio
from .ordered import running_totals, sequence_number, trailing_rows

# Fixed value: time one batch stands for in the throughput figure.
BATCH_SECONDS = 30
# Fixed value: batches in the recent mean latency.
RECENT = 20


def running_metrics(batches: DataFrame, batch_seconds: int = BATCH_SECONDS) -> DataFrame:
    """Totals so far and the figures derived from them, one row per batch.

    ``batches`` has ``batch_no`` (unique), ``rows``, ``errors`` and ``latency_ms``.
    """
    counted = batches.withColumn("_one", F.lit(1))
    totals = running_totals(counted, "batch_no", {
        "total_events": "rows", "total_errors": "errors", "total_latency_ms": "latency_ms", "batches": "_one",
    })
    minutes = f"greatest(batches * {batch_seconds}, 60)"
    return totals.select(
        "batch_no",
        "rows",
        (F.col("latency_ms") / 1000.0).alias("latency_s"),
        "total_events",
        "total_errors",
        half_up_ratio("total_latency_ms", "batches * 1000", 3).alias("mean_latency_s"),
        half_up_ratio("total_events * 60", minutes, 2).alias("throughput_per_min"),
        half_up_ratio("total_errors * 100", "greatest(total_events, 1)", 2).alias("error_pct"),
    )


def recent_latency(batches: DataFrame, k: int = RECENT) -> DataFrame:
    """Mean latency of the last ``k`` batches at each batch, in milliseconds to one decimal."""
    numbered = sequence_number(batches.select("batch_no", "latency_ms"), "batch_no", "number")
    tail = trailing_rows(numbered, "number", k, {
        "ms": lambda w: F.sum("latency_ms").over(w), "n": lambda w: F.count("latency_ms").over(w),
    })
    return tail.select("batch_no", "latency_ms", half_up_ratio("ms", "n", 1).alias("recent_latency_ms"))


def operating_summary(batches: DataFrame) -> DataFrame:
    """Batches, events, errors and mean latency; no row when nothing ran."""
    one = batches.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("total_events"),
        F.sum("errors").alias("total_errors"), F.sum("latency_ms").alias("ms"),
    ).where("batches > 0")
    return one.select("batches", "total_events", "total_errors", half_up_ratio("ms", "batches * 1000", 2).alias("mean_latency_s"))
