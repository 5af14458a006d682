"""Readings view of the generic ``events`` table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.fixedpoint import usable
from ..session import pin

# Descriptions used when a reading needs one, by event_id modulo 8.
DESCRIPTIONS = [
    "cielo claro", "despejado", "nubes dispersas", "algo de nubes",
    "muy nuboso", "lluvia ligera", "lluvia moderada", "llovizna",
]

# Files that a micro-batch takes at most: with files of a gigabyte, a terabyte at a time.
FILES_PER_TRIGGER = 1000


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """The events table, or a folder of its parts, as a file stream with instant timestamps."""
    pin(spark)
    schema = spark.read.parquet(path).schema
    raw = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def readings(events_df: DataFrame) -> DataFrame:
    """Engine columns of each event: one station per event type.

    Built from columns that the table already has, so that pruning reaches the scan. Decimals stay as they are: values
    of two decimals are shifted as hundredths, all others as wide decimals.
    """
    value = usable(F.col("value").cast("double"))
    cents = F.rint(value * 100).cast("bigint")
    short, fine = cents / 100.0 == value, value.cast("decimal(36,18)")
    humidity = F.get_json_object("props", "$.k").cast("int")
    wind_cents = F.col("event_id") % 2000
    # Whole hundredths below the temperature.
    below = 2000 + humidity * 4 - F.floor(wind_cents * 8 / 100).cast("bigint")

    def lowered(by: Column) -> Column:
        exact = fine - by.cast("decimal(20,0)") * F.lit(Decimal("0.01"))
        return F.when(short, (cents - by) / 100.0).otherwise(exact.cast("double"))

    return events_df.select(
        "event_id",
        F.col("event_type").alias("station"),
        "ts",
        lowered(F.lit(2000)).alias("temp"),
        humidity.alias("humidity"),
        (F.lit(950) + F.col("user_id")).cast("int").alias("pressure"),
        (wind_cents / 100.0).alias("wind"),
        lowered(below).alias("feels_like"),
        F.hour("ts").alias("hour_of_day"),
        F.weekday("ts").alias("day_of_week"),
    )


def full_readings(events_df: DataFrame) -> DataFrame:
    """Readings with all 17 event fields, as the wire carries them (UTC offset)."""
    pick = F.element_at(
        F.array(*[F.lit(d) for d in DESCRIPTIONS]), (F.col("event_id") % 8 + 1).cast("int")
    )
    return readings(events_df).withColumns({
        "ts_raw": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
        "country": F.lit("PE"),
        "lat": F.lit(-15.5),
        "lon": F.lit(-70.13),
        "temp_min": F.col("temp") - 1,
        "temp_max": F.col("temp") + 1,
        "description": pick,
        "cloud_pct": (F.col("event_id") % 101).cast("int"),
        "visibility": (F.col("event_id") % 10000).cast("int"),
    })
