"""Raw rows joined with one short row per key, without a shuffle of the raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A side of one key and one time per row is broadcast up to this many counted rows.
BROADCAST_KEYS = 100_000


def join_per_key(df: DataFrame, per_key: DataFrame, keys: list[str], limit: int = BROADCAST_KEYS, how: str = "inner") -> DataFrame:
    """``df`` joined with ``per_key``, which has been written out and is counted here.

    Up to ``limit`` rows it is broadcast and raw rows stay where they are, so a key with a third of them costs
    nothing. Beyond that both sides are shuffled, and adaptive execution splits what is skewed.
    """
    return df.join(F.broadcast(per_key) if per_key.count() <= limit else per_key, keys, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by equal keys, where null equals null."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(right, on, how).drop(*[f"_right_{k}" for k in keys])
