"""Nested service payloads landed as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.calendar import local_time
from ..schema import PAYLOAD_SCHEMA


def read_payloads(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Landed payload files, one JSON document per line, in ``value``."""
    return (spark.readStream if streaming else spark.read).text(path)


def flatten_payload(df: DataFrame, observed_at: Column | None = None, *keep: str, zone: str | None = None) -> DataFrame:
    """Event columns of nested payloads.

    ``observed_at`` is the landing time (a timestamp column, default now). Temperatures and
    wind are rounded to two decimals; a missing visibility becomes 0.
    """
    at = observed_at if observed_at is not None else F.current_timestamp()
    doc = df.select(
        *keep, at.alias("ts"), F.from_json(F.col("value").cast("string"), PAYLOAD_SCHEMA).alias("p")
    )
    local = local_time("ts", zone)
    return doc.select(
        *keep,
        "ts",
        F.col("p.name").alias("station"),
        F.col("p.sys.country").alias("country"),
        F.col("p.coord.lat").alias("lat"),
        F.col("p.coord.lon").alias("lon"),
        F.round("p.main.temp", 2).alias("temp"),
        F.round("p.main.feels_like", 2).alias("feels_like"),
        F.round("p.main.temp_min", 2).alias("temp_min"),
        F.round("p.main.temp_max", 2).alias("temp_max"),
        F.col("p.main.humidity").alias("humidity"),
        F.col("p.main.pressure").alias("pressure"),
        F.get(F.col("p.weather"), 0)["description"].alias("description"),
        F.col("p.clouds.all").alias("cloud_pct"),
        F.round("p.wind.speed", 2).alias("wind"),
        F.coalesce(F.col("p.visibility"), F.lit(0)).alias("visibility"),
        F.hour(local).alias("hour_of_day"),
        F.weekday(local).alias("day_of_week"),
    )
