"""Small state tables that a batch callback folds forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Slots:
    """Two alternating folders per state table.

    Batch n reads slot (n-1) mod 2 and replaces slot n mod 2. A replayed batch therefore starts
    from the same state and gives the same result, and old state needs no cleaning.
    """

    def __init__(self, root: str):
        self.root = root

    def path(self, part: str, batch_id: int) -> str:
        return f"{self.root}/{part}/slot={batch_id % 2}"

    def before(self, spark: SparkSession, part: str, batch_id: int) -> DataFrame | None:
        """State the previous batch left; none for the first batch."""
        return None if batch_id == 0 else spark.read.parquet(self.path(part, batch_id - 1))

    def now(self, spark: SparkSession, part: str, batch_id: int) -> DataFrame:
        return spark.read.parquet(self.path(part, batch_id))

    def save(self, df: DataFrame, part: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.path(part, batch_id))
