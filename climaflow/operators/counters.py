"""Counter increases and rates over sampled counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.calendar import epoch_seconds
from .ordered import previous_row, trailing_seconds


def _growth(now: str, before: str) -> Column:
    """From one sample to the next; after a reset the value itself; 0 without a sample before."""
    grown = F.when(F.col(now) < F.col(before), F.col(now)).otherwise(F.col(now) - F.col(before))
    return F.when(F.col(before).isNull(), F.lit(0)).otherwise(grown).cast("bigint")


def samples(df: DataFrame, value: str, keys: tuple[str, ...] = ("station",)) -> DataFrame:
    """Per key and second: the first and the newest value, and the growth over all samples between them.

    A second is the finest step the rates look at. Samples are ordered within their second only, so a busy station is
    spread over as many groups as it has seconds; the rows that go on are at most 86,400 per key and day.
    """
    order = W.partitionBy(*keys, "sec").orderBy("ts", "event_id", "v")
    known = df.where(F.col("ts").isNotNull() & F.col(value).isNotNull())
    rows = known.select(*keys, epoch_seconds("ts").alias("sec"), "ts", "event_id", F.col(value).alias("v"))
    linked = rows.withColumns({"before": F.lag("v").over(order), "after": F.lead("v").over(order)})
    return linked.groupBy(*keys, "sec").agg(
        F.max(F.when(F.col("before").isNull(), F.col("v"))).alias("first_v"),
        F.max(F.when(F.col("after").isNull(), F.col("v"))).alias("v"),
        F.sum(_growth("v", "before")).alias("inside"),
    )


def increases(sampled: DataFrame, keys: tuple[str, ...] = ("station",)) -> DataFrame:
    """Growth of each second, from the newest sample before it on: every sample counts."""
    linked = previous_row(sampled, keys, "sec", ["v"])
    grown = F.col("inside") + _growth("first_v", "prev_v")
    return linked.withColumn("increase", grown).drop("prev_v", "first_v", "inside")


def counter_rate(df: DataFrame, value: str, span_s: int, keys: tuple[str, ...] = ("station",)) -> DataFrame:
    """Increase within the trailing ``span_s`` seconds and its rate per minute at each second with a sample."""
    grown = increases(samples(df, value, keys), keys)
    summed = trailing_seconds(grown, keys, "sec", span_s, {"window_increase": lambda w: F.sum("increase").over(w)})
    per_minute: Column = F.round(F.col("window_increase") * 60.0 / span_s, 6)
    return summed.select(*keys, "sec", "v", "increase", "window_increase", per_minute.alias("rate_per_min"))


def counter_bootstrap(history: DataFrame, arriving: DataFrame, keys: tuple[str, ...] = ("station",)) -> DataFrame:
    """Counter start taken from stored history plus what has arrived since."""
    stored = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("stored"))
    fresh = arriving.groupBy(*keys).agg(F.count(F.lit(1)).alias("arrived"))
    both = stored.join(fresh, list(keys), "full")
    zero = F.lit(0).cast("bigint")
    return both.select(
        *keys,
        F.coalesce("stored", zero).alias("stored"),
        F.coalesce("arrived", zero).alias("arrived"),
        (F.coalesce("stored", zero) + F.coalesce("arrived", zero)).alias("total"),
    )
