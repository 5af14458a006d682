"""Stored readings and hourly history as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import HOURLY_HISTORY_SCHEMA, STORED_FIELDS, stored_schema, to_engine_names


def read_hourly_history(spark: SparkSession, path: str) -> DataFrame:
    """Hourly history CSV as readings ``ts, temp, pressure``."""
    raw = spark.read.schema(HOURLY_HISTORY_SCHEMA).option("header", True).csv(path)
    return raw.select(
        F.col("hora").alias("ts"), F.col("temperatura").alias("temp"), F.col("presion").alias("pressure")
    )


def read_stored_csv(spark: SparkSession, path: str) -> DataFrame:
    return to_engine_names(spark.read.schema(stored_schema()).option("header", True).csv(path))


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def training_scan(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Time and temperature of rows that have both; ordered only where the output needs it."""
    rows = df.select("ts", "temp").where(F.col("ts").isNotNull() & F.col("temp").isNotNull())
    return rows.orderBy("ts") if ordered else rows


def stored_projection(df: DataFrame) -> DataFrame:
    """The 13 fields storage keeps."""
    return df.select(*STORED_FIELDS)
