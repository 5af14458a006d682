"""Stored readings: date-partitioned tables, CSV and small-file compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import to_wire_names
from ..sources.files import stored_projection

# Rows per file of bulk writes. A sink fed event by event used files of 50 rows; ``rows_per_file``
# still allows that, but no default asks a file system for it.
ROWS_PER_FILE = 5_000_000


def append_table(df: DataFrame, path: str, mode: str = "append", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append readings to a table partitioned by date, sorted by time within files.

    The rebalance lets adaptive execution split a heavy date over several tasks and merge
    light ones, so neither skew nor small files build up. Creates the table when absent.
    """
    dated = df.withColumns({"date": F.to_date("ts"), "ingested_at": F.current_timestamp()})
    (
        dated.hint("rebalance", "date")
        .sortWithinPartitions("date", "ts")
        .write.mode(mode).partitionBy("date")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def append_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append the 13 stored fields under wire names; each part file carries the header."""
    to_wire_names(stored_projection(df)).write.mode(mode).option("header", True).csv(path)


def append_parquet(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, mode: str = "append") -> None:
    """Append the 13 stored fields in files of at most ``rows_per_file`` rows.

    Every micro-batch is written out whole; nothing waits in a buffer.
    """
    (
        to_wire_names(stored_projection(df))
        .write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)
    )


def compact(spark: SparkSession, source: str, target: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Rewrite many small files as few large ones in a new folder."""
    (
        spark.read.parquet(source).hint("rebalance")
        .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(target)
    )

