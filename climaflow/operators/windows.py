"""Event-time window aggregates, the same builder for batch and stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixedpoint import exact_mean_of, exact_sum, half_up_ratio, mean_of, usable


def _partials() -> dict[str, Column]:
    return {
        "_temp_sum": exact_sum("temp"),
        "_temp_n": F.count(usable("temp")),
        "_temp_hi": F.max(usable("temp")),
        "_temp_lo": F.min(usable("temp")),
        "_hum_sum": F.sum(F.col("humidity").cast("bigint")),
        "_hum_n": F.count("humidity"),
        "_wind_sum": exact_sum("wind"),
        "_wind_n": F.count(usable("wind")),
        "_feels_sum": exact_sum("feels_like"),
        "_feels_n": F.count(usable("feels_like")),
        "_rows": F.count(F.lit(1)),
    }


def _measures() -> dict[str, tuple[list[str], Column]]:
    return {
        "avg_temp": (["_temp_sum", "_temp_n"], mean_of("_temp_sum", "_temp_n")),
        "max_temp": (["_temp_hi"], F.col("_temp_hi")),
        "min_temp": (["_temp_lo"], F.col("_temp_lo")),
        "avg_humidity": (["_hum_sum", "_hum_n"], half_up_ratio("_hum_sum", "_hum_n", 1)),
        "avg_wind": (["_wind_sum", "_wind_n"], mean_of("_wind_sum", "_wind_n")),
        "avg_feels_like": (["_feels_sum", "_feels_n"], mean_of("_feels_sum", "_feels_n")),
        "mean_temp": (["_temp_sum", "_temp_n"], exact_mean_of("_temp_sum", "_temp_n")),
        "events": (["_rows"], F.col("_rows")),
    }


FULL_MEASURES = (
    "avg_temp", "max_temp", "min_temp", "avg_humidity", "avg_wind", "avg_feels_like", "events",
)
SHORT_MEASURES = ("avg_temp", "avg_humidity", "avg_wind", "events")
TRIAL_MEASURES = ("mean_temp", "events")


@dataclass(frozen=True)
class WindowSpec:
    """Width, lateness bound, grouping columns and measures of a windowed aggregate."""

    width: str = "5 minutes"
    watermark: str = "2 minutes"
    keys: tuple[str, ...] = ("hour_of_day", "station")
    measures: tuple[str, ...] = FULL_MEASURES
    slide: str | None = None


def windowed_aggregate(df: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Tumbling event-time aggregate of readings.

    Rows with a null ``ts`` belong to no window. Partial sums are combined before the
    shuffle, so a station that holds most rows still sends one row per window and task.
    """
    if df.isStreaming:
        df = df.withWatermark("ts", spec.watermark)
    catalogue, partials = _measures(), _partials()
    needed = sorted({p for m in spec.measures for p in catalogue[m][0]})
    frame = F.window("ts", spec.width, spec.slide) if spec.slide else F.window("ts", spec.width)
    grouped = df.groupBy(frame.alias("w"), *spec.keys).agg(*[partials[p].alias(p) for p in needed])
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *spec.keys,
        *[catalogue[m][1].alias(m) for m in spec.measures],
    )


def newest_first(windows: DataFrame) -> DataFrame:
    return windows.orderBy(F.col("window_start").desc(), *[
        c for c in ("hour_of_day", "station") if c in windows.columns
    ])
