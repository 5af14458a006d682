"""Gap-free hourly series per station and the features built on it.

Hourly rows per station are bounded by the calendar (8,784 a year), so windows per station are
safe here whatever the number of raw readings behind an hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.calendar import cyclic_hour
from ..functions.fixedpoint import exact_mean_of, exact_sum, usable

LAGS = (1, 2, 24, 168)
ROLLING = (3, 24)
HORIZONS = (1, 24, 168)
# Days whose missing hours are filled at a time.
GAP_BLOCK_DAYS = 30


def hourly_means(df: DataFrame, keys: tuple[str, ...] = ("station",)) -> DataFrame:
    """Mean temperature per station and hour; null where an hour has only nulls."""
    grouped = df.where(F.col("ts").isNotNull()).groupBy(
        *keys, F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hr")
    ).agg(exact_sum("temp").alias("s"), F.count(usable("temp")).alias("n"))
    return grouped.select(*keys, "hr", exact_mean_of("s", "n").alias("temp"))


def interpolate_hours(hourly: DataFrame, keys: tuple[str, ...] = ("station",)) -> DataFrame:
    """Every hour from first to last, gaps filled linearly in time.

    Each known hour emits itself and the missing hours up to the next known one, so no grid is
    joined. Hours before the first known value stay null; hours after the last one repeat it. A
    key without any known value has all its hours as nulls.
    """
    whole = W.partitionBy(*keys)
    spans = hourly.withColumns({
        "lo": F.min("hr").over(whole), "hi": F.max("hr").over(whole), "n_known": F.count("temp").over(whole),
    })
    known = spans.where(F.col("temp").isNotNull() | ((F.col("n_known") == 0) & (F.col("hr") == F.col("lo"))))
    order = whole.orderBy("hr")
    linked = known.withColumns({
        "next_hr": F.lead("hr").over(order),
        "next_temp": F.lead("temp").over(order),
        "is_first": F.row_number().over(order) == 1,
    })
    hour = F.expr("INTERVAL 1 HOUR")
    start = F.when(F.col("is_first"), F.col("lo")).otherwise(F.col("hr"))
    stop = F.coalesce(F.col("next_hr") - hour, F.col("hi"))
    # A reading with a wrong year makes a gap of any length: it is filled block by block, never held as one array.
    block = F.expr(f"INTERVAL {GAP_BLOCK_DAYS} DAY")
    blocks = linked.withColumn("stop", stop).withColumn("block_from", F.explode(F.sequence(start, F.col("stop"), block)))
    block_stop = F.least(F.col("stop"), F.col("block_from") + block - hour)
    cells = blocks.withColumn("at", F.explode(F.sequence(F.col("block_from"), block_stop, hour)))

    def secs(c: str):
        return F.unix_seconds(F.col(c).cast("timestamp"))

    slope = (F.col("next_temp") - F.col("temp")) / (secs("next_hr") - secs("hr"))
    value = (
        F.when(F.col("at") < F.col("hr"), F.lit(None).cast("double"))
        .when(F.col("next_hr").isNull() | (F.col("at") == F.col("hr")), F.col("temp"))
        .otherwise(F.col("temp") + slope * (secs("at") - secs("hr")))
    )
    filled = (F.col("at") != F.col("hr")) | F.col("temp").isNull()
    return cells.select(*keys, F.col("at").alias("hr"), value.alias("temp"), filled.alias("filled"))


def lag_columns(keys: tuple[str, ...] = ("station",), hours=LAGS) -> dict:
    w = W.partitionBy(*keys).orderBy("hr")
    return {f"lag_{n}": F.lag("temp", n).over(w) for n in hours}


def rolling_columns(keys: tuple[str, ...] = ("station",), widths=ROLLING) -> dict:
    """Means of the last rows, over whole millionths of a degree: exact sums, so a mean does not
    depend on the order in which an engine adds its window."""
    w = W.partitionBy(*keys).orderBy("hr")
    micro = F.rint(F.col("temp") * 1000000).cast("bigint")
    frames = {n: w.rowsBetween(-(n - 1), 0) for n in widths}
    return {f"roll_{n}": F.sum(micro).over(f) / F.count(micro).over(f) / 1000000.0 for n, f in frames.items()}


def target_columns(keys: tuple[str, ...] = ("station",), horizons=HORIZONS) -> dict:
    w = W.partitionBy(*keys).orderBy("hr")
    return {f"target_{h}": F.lead("temp", h).over(w) for h in horizons}


def cyclic_columns() -> dict:
    sin, cos = cyclic_hour(F.hour("hr"))
    return {"hour_sin": sin, "hour_cos": cos}


def forecast_frame(df: DataFrame, keys: tuple[str, ...] = ("station",)) -> DataFrame:
    """Features known at each hour and the temperatures 1, 24 and 168 hours later."""
    grid = interpolate_hours(hourly_means(df, keys), keys)
    return grid.withColumns({
        **lag_columns(keys), **rolling_columns(keys), **target_columns(keys), **cyclic_columns(),
    })
