"""Helpers of several operators: sizes that decide on broadcasts, salted joins, seeded hashes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import session

# A joined side is broadcast up to this many rows of at most some hundred bytes.
BROADCAST_ROWS = 100_000
# Copies of each row of a small side where it is too large to broadcast, and parts of its hot keys.
SALTS = 16


# Folders of written tables of the stage that is being made, if a pipeline asks for them.
_collected: list[str] | None = None


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run below the shared folder."""
    path = session.run_dir(spark, label)
    if _collected is not None:
        _collected.append(path)
    return path


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The folders that are made meanwhile, to be deleted with ``delete`` when nothing reads them any more."""
    global _collected
    before, _collected = _collected, []
    try:
        yield _collected
    finally:
        _collected = before


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, label: str = "cut") -> tuple[DataFrame, str]:
    """The rows written below the shared folder and read back, and the folder."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(f"{path}/rows.parquet")
    return spark.read.schema(df.schema).parquet(f"{path}/rows.parquet"), path


def cut(df: DataFrame) -> DataFrame:
    """The rows written below the shared folder and read back: lineage ends there, and lost executors cost nothing.

    A table and no checkpoint, as that would carry along the constraints that the optimizer has found, which grow with
    every step of an iteration.
    """
    return written(df)[0]


def join_small(rows: DataFrame, small: DataFrame, keys: list[str], n_small: int) -> DataFrame:
    """``rows`` left-joined with the narrow table ``small`` of ``n_small`` counted rows; null keys are equal.

    Up to ``BROADCAST_ROWS`` the small side is broadcast and ``rows`` stay where they are. Beyond that both sides are
    shuffled, every small row once per salt, so that a key with a third of all rows is spread over ``SALTS`` tasks.
    """
    small = small.select(*[F.col(k).alias(f"_small_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_small_{k}"))
        on = same if on is None else on & same
    drop = [f"_small_{k}" for k in keys]
    if n_small <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), on, "left").drop(*drop)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    small = small.withColumn("_small_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(small, on & (F.col("_salt") == F.col("_small_salt")), "left").drop(*drop, "_salt", "_small_salt")


def unit_hash(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the values alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def root_parts(n: int) -> int:
    """Parts that hold about as many rows each as there are parts: neither grows faster than the root of the rows."""
    return max(1, math.isqrt(max(n, 1)))


def remainder_of_id(column: str, parts: int) -> Column:
    """``crc32`` of the id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts
