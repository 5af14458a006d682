"""Newest rows: the last k per station, the event log, the latest reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.calendar import clock_text, epoch_millis
from ..session import cut
from .history import newest
from .keyed import join_per_key

NEWEST = ("ts", "event_id")
# Ranges of days that a scan is pruned by, and days that are looked through for them.
MAX_RUNS, MAX_DAYS = 64, 10_000


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, position: str = "position") -> DataFrame:
    """First ``k`` rows per key, in two levels.

    Level one ranks within (key, input partition group): Spark keeps k rows per key and task
    before the shuffle, and the groups spread a hot key over many tasks. Level two ranks the
    few survivors. The grouping decides only where a row is ranked, never whether it is kept.
    """
    spread = df.withColumn("_group", F.spark_partition_id() % 64)
    first = spread.withColumn("_r", F.row_number().over(W.partitionBy(*keys, "_group").orderBy(*order)))
    kept = first.where(F.col("_r") <= k).drop("_r", "_group")
    ranked = kept.withColumn(position, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(position) <= k)


def _newest_first() -> list[Column]:
    return [F.col(c).desc() for c in NEWEST]


def _day_runs(days: list[int]) -> list[tuple[int, int]]:
    """First day of each run of neighbouring days and the day after it; days are counted from 1970."""
    runs: list[tuple[int, int]] = []
    for day in days:
        if runs and runs[-1][1] == day:
            runs[-1] = (runs[-1][0], day + 1)
        else:
            runs.append((day, day + 1))
    return runs


def _in_runs(column: Column, runs: list[tuple[int, int | None]], kind) -> Column:
    found = F.lit(False)
    for first, after in runs:
        inside = column >= F.date_from_unix_date(F.lit(first)).cast(kind)
        if after is not None:
            inside = inside & (column < F.date_from_unix_date(F.lit(after)).cast(kind))
        found = found | inside
    return found


def recent_days(df: DataFrame, keys: list[str], k: int, day: str | None = None) -> DataFrame:
    """Rows from the day on that surely holds each key's newest ``k``; the rest cannot be among them.

    A first pass reads only key and time and counts rows per key and day, which the calendar bounds. The days that some
    key needs become ranges of time that prune the wide second pass, so that a long history is not sorted to find its
    end, and a key that stopped long ago adds its own last days and not all since. Where they form more than ``MAX_RUNS``
    ranges, the oldest day alone bounds the pass. ``day`` names a column that holds the date of ``ts``, as tables
    partitioned by date have; its partitions are then pruned as well.
    """
    own_day = F.to_date("ts") if day is None else F.col(day)
    days = df.where(F.col("ts").isNotNull()).groupBy(*keys, own_day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    later = W.partitionBy(*keys).orderBy(F.col("_day").desc()).rowsBetween(W.unboundedPreceding, -1)
    needed = days.withColumn("_after", F.coalesce(F.sum("_n").over(later), F.lit(0))).where(F.col("_after") < k)
    needed = cut(needed.select(*keys, "_day"))
    starts = needed.groupBy(*keys).agg(F.min("_day").cast("timestamp_ntz").alias("_start"))
    first_days = needed.select(F.unix_date("_day").alias("d")).distinct().orderBy("d").limit(MAX_DAYS + 1)
    some = [r["d"] for r in first_days.collect()]
    runs = _day_runs(some)
    if len(some) > MAX_DAYS or len(runs) > MAX_RUNS:
        runs = [(some[0], None)]
    wide = df.where(_in_runs(F.col("ts"), runs, df.schema["ts"].dataType))
    if day is not None:
        wide = wide.where(_in_runs(F.col(day), runs, "date"))
    return join_per_key(wide, starts, keys).where(F.col("ts") >= F.col("_start")).drop("_start")


def _newest_k(df: DataFrame, columns: list[str], keys: list[str], k: int, position: str, day: str | None) -> DataFrame:
    return top_k(recent_days(df, keys, k, day).select(*keys, *columns), keys, _newest_first(), k, position)


def last_series(df: DataFrame, k: int = 60, keys: list[str] | None = None, day: str | None = None) -> DataFrame:
    """The last ``k`` points of the four live series per station; ``age`` 1 is the newest."""
    return _newest_k(df, ["ts", "event_id", "temp", "humidity", "wind", "pressure"], keys or ["station"], k, "age", day)


def event_log(df: DataFrame, k: int = 10, keys: list[str] | None = None, day: str | None = None) -> DataFrame:
    """Newest ``k`` events per station with their clock text and sky description."""
    columns = ["ts", "event_id", "ts_raw", "temp", "humidity", "wind", "description"]
    newest = _newest_k(df, columns, keys or ["station"], k, "age", day)
    return newest.withColumn("clock", clock_text("ts_raw")).drop("ts_raw")


def latest_reading(df: DataFrame) -> DataFrame:
    """Newest temperature, wind and humidity of the whole table.

    The newest time is a scalar subquery on one column; its filter leaves the wide pass a few rows.
    """
    slim = df.select("ts", "event_id", "station", "temp", "wind", "humidity")
    return slim.where(F.col("ts") == newest(df)).orderBy(*_newest_first()).limit(1)


def latest_per_station(df: DataFrame, day: str | None = None) -> DataFrame:
    return _newest_k(df, ["ts", "event_id", "temp", "wind", "humidity"], ["station"], 1, "position", day).drop("position")


def panel_history(df: DataFrame, measure: str, ordered: bool = True) -> DataFrame:
    """Epoch milliseconds and value of one measure, oldest first."""
    rows = df.select(epoch_millis("ts").alias("time_ms"), F.col(measure).alias("value"), "event_id")
    return rows.orderBy("time_ms", "event_id") if ordered else rows


def first_rows(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` oldest rows of the six training columns."""
    slim = df.select("event_id", "ts", "temp", "humidity", "pressure", "hour_of_day", "day_of_week")
    return slim.orderBy("ts", "event_id").limit(k)


def latest_per_key(revisions: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Newest revision of each key of an update-mode output.

    Keys are many and have few revisions each, so one ranking level is enough.
    """
    w = W.partitionBy(*keys).orderBy(F.col(version).desc())
    return revisions.withColumn("_p", F.row_number().over(w)).where("_p = 1").drop("_p")
