"""Roll-ups over a trailing period and dense hour-of-day heat maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import day_label, hour_label, month_label
from ..functions.fixedpoint import exact_sum, mean_of, usable
from ..session import cut
from .keyed import join_per_key

PERIODS = ("day", "week", "month", "year")

# Length in days of the sliding periods.
SLIDING_DAYS = {"week": 7, "month": 30}


def _within(period: str, ts: Column, anchor: Column) -> Column:
    """Condition that ``ts`` lies in the period that ends at ``anchor``."""
    if period == "day":
        return ts >= F.date_trunc("day", anchor).cast("timestamp_ntz")
    if period in SLIDING_DAYS:
        return ts >= anchor - F.expr(f"INTERVAL {SLIDING_DAYS[period]} DAYS")
    if period == "year":
        return ts.isNotNull()
    raise ValueError(f"unknown period: {period}")


def newest(df: DataFrame) -> Column:
    """Largest ``ts`` of the table as a scalar subquery; Spark runs it once and plugs it in."""
    return df.select(F.max("ts").alias("anchor")).scalar()


def _dated(df: DataFrame, period: str, anchor: Column, day: str | None) -> DataFrame:
    """Rows of the period that ends at ``anchor``; ``day`` names a column with the date of ``ts`` to prune by."""
    if day is not None:
        df = df.where(F.col(day) >= F.to_date(anchor) - F.expr(f"INTERVAL {SLIDING_DAYS.get(period, 0)} DAYS"))
    return df.where(_within(period, F.col("ts"), anchor))


def trailing_period(df: DataFrame, period: str, per: str | None = None, day: str | None = None) -> DataFrame:
    """Rows of the period that ends at the newest row, of the table or of each ``per`` key.

    ``day`` names a column that holds the date of ``ts``, as tables partitioned by date have; it prunes partitions.
    """
    if period == "year":
        return df.where(F.col("ts").isNotNull())
    if per is None:
        return _dated(df, period, newest(df), day)
    anchors = cut(df.groupBy(per).agg(F.max("ts").alias("_anchor")))
    # The oldest anchor bounds the scan before each key's own one is looked up.
    recent = _dated(df, period, anchors.agg(F.min("_anchor")).scalar(), day)
    own = join_per_key(recent, anchors, [per])
    return own.where(_within(period, F.col("ts"), F.col("_anchor"))).drop("_anchor")


def _bucket(period: str) -> Column:
    if period == "day":
        return F.hour("ts")
    if period in SLIDING_DAYS:
        return F.to_date("ts")
    return F.trunc(F.to_date("ts"), "month")


def _label(period: str) -> Column:
    bucket = F.col("bucket")
    if period == "day":
        return hour_label(bucket)
    return day_label(bucket) if period in SLIDING_DAYS else month_label(bucket)


def history(df: DataFrame, period: str, per: str | None = None, day: str | None = None) -> DataFrame:
    """Mean temperature and pressure by hour (day), date (week, month) or month (year).

    ``bucket`` sorts, ``label`` shows.
    """
    keys = [per] if per else []
    grouped = (
        trailing_period(df, period, per, day)
        .groupBy(*keys, _bucket(period).alias("bucket"))
        .agg(
            exact_sum("temp").alias("_t"), F.count(usable("temp")).alias("_tn"),
            exact_sum("pressure").alias("_p"), F.count(usable("pressure")).alias("_pn"),
        )
    )
    return grouped.select(
        *keys,
        "bucket",
        _label(period).alias("label"),
        mean_of("_t", "_tn").alias("avg_temp"),
        mean_of("_p", "_pn").alias("avg_pressure"),
    )


def heatmaps(df: DataFrame, periods: tuple[str, ...] = PERIODS) -> DataFrame:
    """Mean temperature and row count of all 24 hours, for each period.

    One scan feeds all periods: each hour keeps one conditional sum per period, so the shuffle
    carries 24 rows per task whatever the table's size. The mean skips nulls, the count does not.
    """
    anchor = newest(df)
    flagged = df.select(
        F.hour("ts").alias("hour"),
        usable("temp").alias("t"),
        *[_within(p, F.col("ts"), anchor).alias(p) for p in periods],
    )
    sums = [
        agg.alias(f"{p}_{part}")
        for p in periods
        for part, agg in (
            ("s", exact_sum("t", F.col(p))),
            ("k", F.count(F.when(F.col(p), F.col("t")))),
            ("n", F.count(F.when(F.col(p), 1))),
        )
    ]
    by_hour = flagged.where(F.col("hour").isNotNull()).groupBy("hour").agg(*sums)
    hours = df.sparkSession.range(0, 24, 1, 1).select(F.col("id").cast("int").alias("hour"))
    dense = hours.join(by_hour, "hour", "left")
    rows = ", ".join(f"'{p}', {p}_s, {p}_k, coalesce({p}_n, 0L)" for p in periods)
    long = dense.select("hour", F.expr(f"stack({len(periods)}, {rows}) as (period, s, k, events)"))
    return long.select("period", "hour", mean_of("s", "k").alias("avg_temp"), "events")


def hour_heatmap(df: DataFrame) -> DataFrame:
    """Sparse running heat map: exact mean and count by sender hour. Works on streams too."""
    return df.groupBy("hour_of_day").agg(
        exact_sum("temp").alias("temp_sum"),
        F.count(usable("temp")).alias("temp_n"),
        F.count(F.lit(1)).alias("events"),
    )


def heatmap_means(sums: DataFrame) -> DataFrame:
    return sums.select("hour_of_day", mean_of("temp_sum", "temp_n").alias("avg_temp"), "events")


def table_summary(df: DataFrame) -> DataFrame:
    """Row count, first and last time and mean temperature in one pass."""
    one = df.agg(
        F.count(F.lit(1)).alias("events"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        exact_sum("temp").alias("_t"),
        F.count(usable("temp")).alias("_n"),
    )
    return one.select("events", "first_ts", "last_ts", mean_of("_t", "_n").alias("avg_temp"))


def rounded_means(df: DataFrame, key: str = "station") -> DataFrame:
    """Mean temperature to 1, 2 and 3 decimals per key."""
    sums = df.groupBy(key).agg(exact_sum("temp").alias("s"), F.count(usable("temp")).alias("n"))
    return sums.select(
        key,
        *[mean_of("s", "n", d).alias(f"avg_temp_{d}dp") for d in (1, 2, 3)],
    )
