"""Training frames: calendar cells of readings, and the train/test split.

The four calendar features take at most 24 x 7 x 12 x 53 combinations, whatever the number of
readings. Readings are combined into one weighted row per combination before any model sees
them; squared-error models fit the same on weighted means as on the rows behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from ..functions.calendar import CALENDAR_FEATURES, MODEL_ZONE, with_calendar
from ..functions.fixedpoint import exact_mean_of_hundredths, hundredths

TEST_EVERY = 5
MIN_ROWS = 20
# Partitions of a cell table, fixed so that fits repeat. At most 107k rows: few tasks per job
# matter more than many cores, as boosting runs hundreds of small jobs.
CELL_PARTITIONS = 2


def is_test(key: str = "event_id") -> Column:
    """Every fifth key is a test row; the same rows on every run and any partitioning."""
    return F.pmod(F.col(key), F.lit(TEST_EVERY)) == 0


def labelled(df: DataFrame, zone: str | None = MODEL_ZONE, key: str = "event_id") -> DataFrame:
    """Calendar features, temperature in hundredths and split flag of each usable reading."""
    usable = df.select(key, "ts", "temp").where(F.col("ts").isNotNull() & F.col("temp").isNotNull())
    return with_calendar(usable, "ts", zone).select(
        *CALENDAR_FEATURES, hundredths("temp").alias("c"), is_test(key).alias("is_test")
    )


def cells(rows: DataFrame, features: list[str] = CALENDAR_FEATURES) -> DataFrame:
    """Count and sum per feature combination."""
    return rows.groupBy(*features).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("s"))


def split_cells(rows: DataFrame) -> DataFrame:
    """Cells of both splits from one scan, in a repeatable layout and cut off from their source."""
    grouped = cells(rows, [*CALENDAR_FEATURES, "is_test"])
    fixed = grouped.repartition(CELL_PARTITIONS, *CALENDAR_FEATURES).sortWithinPartitions("is_test", *CALENDAR_FEATURES)
    return cut(fixed)


def training_cells(both: DataFrame) -> DataFrame:
    """Weighted training rows of ``split_cells``."""
    return both.where(~F.col("is_test")).withColumns({
        "label": exact_mean_of_hundredths("s", "n"), "weight": F.col("n").cast("double"),
    })


def split_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("c").alias("temp_sum")
    )
