"""Threshold, backpressure, sustained-condition and silence alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.calendar import epoch_seconds
from ..functions.fixedpoint import half_up_ratio
from .counters import counter_rate

# Alert limits.
LATENCY_MAX_S = 5.0
ERROR_RATE_MAX_PCT = 5.0
BACKPRESSURE_MAX_PCT = 80.0
THROUGHPUT_MIN_PER_MIN = 0.5
TEMP_HIGH, TEMP_LOW = 30, -10
EXTREME_HOLD_S, ERROR_HOLD_S, SILENCE_S, ERROR_SPAN_S = 300, 60, 60, 120


def threshold_alerts(metrics: DataFrame) -> DataFrame:
    """One row per batch and broken limit. Comparisons are strict and use rounded values."""
    def alert(kind: str, severity: str, value: str, limit: float, broken: Column) -> Column:
        return F.when(broken, F.struct(
            F.lit(kind).alias("alert"), F.lit(severity).alias("severity"),
            F.col(value).alias("value"), F.lit(limit).alias("limit_value"),
        ))

    raised = F.array(
        alert("latency", "warning", "latency_s", LATENCY_MAX_S, F.col("latency_s") > LATENCY_MAX_S),
        alert("errors", "error", "error_pct", ERROR_RATE_MAX_PCT, F.col("error_pct") > ERROR_RATE_MAX_PCT),
        alert("throughput", "warning", "throughput_per_min", THROUGHPUT_MIN_PER_MIN,
              F.col("throughput_per_min") < THROUGHPUT_MIN_PER_MIN),
    )
    one = metrics.select("batch_no", F.explode(F.array_compact(raised)).alias("a"))
    return one.select("batch_no", "a.*")


def backpressure(offsets: DataFrame, keys: tuple[str, ...] = ("topic",)) -> DataFrame:
    """Unread messages over all partitions, as a share, with the alert state.

    ``offsets`` has one row per partition with ``end_offset`` and ``current_offset``.
    """
    lag = offsets.groupBy(*keys).agg(F.sum(F.col("end_offset") - F.col("current_offset")).alias("lag"))
    share = F.least(half_up_ratio("lag * 100", "greatest(lag + 10, 1)", 1), F.lit(100.0))
    broken = F.expr("lag * 100 > 80 * greatest(lag + 10, 1)")
    return lag.select(*keys, "lag", share.alias("backpressure_pct"), broken.alias("alert"))


def extreme_temperature(temp: Column) -> Column:
    return (temp > TEMP_HIGH) | (temp < TEMP_LOW)


def sustained(df: DataFrame, flagged: Column, hold_s: int, key: str = "station") -> DataFrame:
    """Runs in which every sample is flagged and that last at least ``hold_s`` seconds.

    Samples that share an instant count as one; it is flagged when all of them are. Rows with
    a null flag are no samples.

    A run lies between two neighbouring unflagged samples. With buckets as long as the hold
    time, a run inside one bucket is too short, so the newest and oldest unflagged sample of
    each bucket are all that is needed to find the runs: a map-side combined aggregate whose
    result is bounded by the calendar. Only buckets at the ends of a long enough run are then
    looked up again for the exact first and last flagged sample.
    """
    rows = df.select(F.col(key), "ts", flagged.alias("flag"))
    rows = rows.where(F.col(key).isNotNull() & F.col("ts").isNotNull() & F.col("flag").isNotNull())
    rows = rows.withColumn("bucket", F.floor(epoch_seconds("ts") / hold_s)).where(F.col("bucket").isNotNull())
    calm = F.when(~F.col("flag"), F.col("ts"))
    buckets = rows.groupBy(key, "bucket").agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"),
        F.min(calm).alias("calm_lo"), F.max(calm).alias("calm_hi"),
    )
    forward = W.partitionBy(key).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    backward = W.partitionBy(key).orderBy(F.col("bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    framed = buckets.withColumns({
        "open": F.last("calm_hi", True).over(forward),
        "close": F.last("calm_lo", True).over(backward),
    })

    # Each bucket touches the run before its first unflagged sample and the run after its last one.
    whole = F.col("calm_lo").isNull()
    before = F.struct(
        F.col("open").alias("open"), F.coalesce("calm_lo", "close").alias("close"),
        F.when(whole | (F.col("lo") < F.col("calm_lo")), F.col("lo")).alias("first"),
        F.when(whole, F.col("hi")).alias("last"),
        (~whole & (F.col("lo") < F.col("calm_lo"))).alias("look_before"), F.lit(False).alias("look_after"),
    )
    after = F.struct(
        F.col("calm_hi").alias("open"), F.col("close").alias("close"),
        F.lit(None).cast(df.schema["ts"].dataType).alias("first"),
        F.when(F.col("hi") > F.col("calm_hi"), F.col("hi")).alias("last"),
        F.lit(False).alias("look_before"), (F.col("hi") > F.col("calm_hi")).alias("look_after"),
    )
    touches = framed.select(
        key, "bucket", F.explode(F.when(whole, F.array(before)).otherwise(F.array(before, after))).alias("t")
    ).select(key, "bucket", "t.*")
    long_enough = (
        F.col("open").isNull() | F.col("close").isNull()
        | (epoch_seconds("close") - epoch_seconds("open") >= hold_s)
    )
    touches = touches.where(long_enough)

    edges = touches.where(F.col("look_before") | F.col("look_after")).select(key, "bucket", "open", "close", "look_before")
    ends = (
        rows.where("flag").join(edges, [key, "bucket"])
        .where(F.when(F.col("look_before"), F.col("ts") < F.col("close")).otherwise(F.col("ts") > F.col("open")))
        .groupBy(key, "open", "close")
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    )
    known = touches.select(key, "open", "close", "first", "last")
    runs = known.unionByName(ends.select(key, "open", "close", "first", "last")).groupBy(key, "open", "close").agg(
        F.min("first").alias("started"), F.max("last").alias("ended"),
    )
    held = F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))
    return (
        runs.withColumn("held_s", held / 1000000.0)
        .where(F.col("held_s") >= hold_s)
        .select(key, "started", "ended", "held_s")
    )


def sustained_extreme(df: DataFrame, hold_s: int = EXTREME_HOLD_S) -> DataFrame:
    return sustained(df, extreme_temperature(F.col("temp")), hold_s)


def sustained_errors(df: DataFrame, value: str, span_s: int = ERROR_SPAN_S, hold_s: int = ERROR_HOLD_S) -> DataFrame:
    """Runs of seconds at which the error counter ``value`` has grown within the trailing span, held long enough."""
    rates = counter_rate(df, value, span_s)
    return sustained(rates.withColumn("ts", F.timestamp_seconds("sec")), F.col("rate_per_min") > 0, hold_s)


def silent_gaps(df: DataFrame, limit_s: int = SILENCE_S, key: str = "station") -> DataFrame:
    """Times between neighbouring readings of a station that are longer than the limit.

    Inside a bucket as long as the limit no such gap fits, so first and last reading per
    bucket are enough; windows then run over buckets, which the calendar bounds.
    """
    buckets = (
        df.where(F.col("ts").isNotNull())
        .groupBy(key, F.floor(epoch_seconds("ts") / limit_s).alias("bucket"))
        .agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    )
    linked = buckets.select(
        key, F.col("hi").alias("silent_from"),
        F.lead("lo").over(W.partitionBy(key).orderBy("bucket")).alias("silent_to"),
    )
    gap = F.unix_micros(F.col("silent_to").cast("timestamp")) - F.unix_micros(F.col("silent_from").cast("timestamp"))
    return linked.withColumn("gap_s", gap / 1000000.0).where(F.col("gap_s") > limit_s)
