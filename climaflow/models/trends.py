"""Forecast grids by hour, week, month and year, and their predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.calendar import day_label, month_name, ordered_hours, padded_hour_label, weekday_name
from .temperature import TemperatureModels

MODES = ("day", "week", "month", "year")
# Days ahead of the daily grids, and the ISO week that stands for each month.
DAYS_AHEAD = {"week": 7, "month": 30}
WEEK_OF_MONTH = [2, 6, 11, 15, 20, 24, 28, 33, 37, 41, 46, 50]


def trend_grid(spark: SparkSession, mode: str, base: Column, hour_from: int = 0, hour_to: int = 23) -> DataFrame:
    """Feature rows of a forecast: ``position`` orders the points, ``label`` names them.

    ``base`` is the first date. Hours outside 0-23 are clamped, reversed ones swapped.
    """
    first, last = ordered_hours(F.lit(hour_from), F.lit(hour_to))
    start = spark.range(1).select(base.cast("date").alias("base"))
    hours = F.explode(F.sequence(first, last)).alias("hour_of_day")
    if mode == "day":
        points = start.select("base", hours)
        return points.select(
            F.col("hour_of_day").alias("position"), padded_hour_label(F.col("hour_of_day")).alias("label"),
            "hour_of_day", *_day_features("base"),
        )
    if mode in DAYS_AHEAD:
        days = start.select("base", F.explode(F.sequence(F.lit(0), F.lit(DAYS_AHEAD[mode] - 1))).alias("position"))
        dated = days.select("position", F.date_add("base", F.col("position")).alias("day")).select("position", "day", hours)
        label = weekday_name(F.weekday("day")) if mode == "week" else day_label(F.col("day"))
        return dated.select("position", label.alias("label"), "hour_of_day", *_day_features("day"))
    if mode == "year":
        months = start.select("base", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("position"))
        named = months.select("position", ((F.month("base") - 1 + F.col("position")) % 12 + 1).alias("month"))
        week = F.element_at(F.array(*[F.lit(w) for w in WEEK_OF_MONTH]), F.col("month"))
        days = named.select("position", "month", week.alias("iso_week"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day_of_week"))
        return days.select("position", "month", "iso_week", "day_of_week", hours).select(
            "position", month_name(F.col("month")).alias("label"), "hour_of_day", "day_of_week", "month", "iso_week"
        )
    raise ValueError(f"unknown mode: {mode}")


def _day_features(day: str) -> list[Column]:
    return [
        F.weekday(day).alias("day_of_week"), F.month(day).alias("month"), F.weekofyear(day).alias("iso_week"),
    ]


def trend(models: TemperatureModels, grid: DataFrame, *keys: str) -> DataFrame:
    """Predicted value per model and point: the mean over the point's grid rows, two decimals.

    ``keys`` names columns that tell several grids in one table apart.
    """
    long = models.long(models.predict_rows(grid), *keys, "position", "label")
    return long.groupBy(*keys, "model", "position", "label").agg(F.round(F.avg("value"), 2).alias("value"))


def trend_grids(spark: SparkSession, base: Column, hour_from: int = 0, hour_to: int = 23) -> DataFrame:
    """The grids of all modes in one table, told apart by ``mode``."""
    parts = [trend_grid(spark, m, base, hour_from, hour_to).select(F.lit(m).alias("mode"), "*") for m in MODES]
    grids = parts[0]
    for part in parts[1:]:
        grids = grids.unionByName(part)
    return grids


def predict_points(models: TemperatureModels, requests: DataFrame) -> DataFrame:
    """Best, forest and boosting prediction of any table of feature requests, two decimals."""
    wide = models.predict_rows(requests)
    return wide.select(
        *requests.columns,
        F.round(models.best, 2).alias("best"),
        F.lit(models.best).alias("best_model"),
        F.round("random_forest", 2).alias("random_forest"),
        F.round("gradient_boosting", 2).alias("gradient_boosting"),
    )
