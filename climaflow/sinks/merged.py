"""The current rows of a stream of revisions, in a bounded number of folders.

Every batch adds one folder of revised rows. Folders of one level are merged to one of the next level when there are
``fan`` of them, and of each key only the newest revision stays. So there are at most ``fan - 1`` folders on each of
log(batches) levels, a row is rewritten once per level, and what a reader scans is bounded by the current rows and the
latest batches, not by the age of the stream.

The list of folders is a version of a manifest, committed after its folders are whole, so a reader never sees a batch or
a merge in part. A batch that a restarted stream repeats is known by its number and left out; one that failed before
its commit replaces what it had written. Folders no longer listed stay for two more versions, for readers that
have just begun. A table belongs to one stream: its batch numbers must count up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.latest import latest_per_key
from .manifest import KEPT, Manifest

FAN = 8
BATCH = "_batch"


class MergedTable:
    """Newest row per ``keys``: of the latest batch, and within a batch the largest by the columns ``newest``, if named."""

    def __init__(self, root: str, keys: list[str], newest: tuple[str, ...] = (), fan: int = FAN):
        self.root, self.keys, self.newest, self.fan = root, list(keys), newest, fan
        self.manifest = Manifest(root)

    def _current(self, rows: DataFrame) -> DataFrame:
        version = F.struct(BATCH, *self.newest)
        return latest_per_key(rows.withColumn("_version", version), self.keys, "_version").drop("_version")

    def _write(self, rows: DataFrame, name: str) -> None:
        self._current(rows).write.mode("overwrite").parquet(f"{self.root}/{name}")

    def state(self, spark: SparkSession) -> tuple[int, dict]:
        version, state = self.manifest.read(spark)
        return version, state or {"through": -1, "folders": [], "dropped": {}}

    def through(self, spark: SparkSession) -> int:
        """Number of the last batch in the table; -1 without any."""
        return self.state(spark)[1]["through"]

    def put(self, rows: DataFrame, batch_id: int, skip_empty: bool = False) -> None:
        """Add a batch; usable as a batch callback. With ``skip_empty`` one without rows adds no folder, for rows that are
        cheap to look at."""
        spark = rows.sparkSession
        version, state = self.state(spark)
        if batch_id <= state["through"]:
            return
        version += 1
        folders, gone, level = list(state["folders"]), [], 0
        if not (skip_empty and rows.count() == 0):
            name = f"rows/batch-{batch_id}"
            self._write(rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")), name)
            folders.append([name, 0])
        while len(full := [n for n, at in folders if at == level]) >= self.fan:
            merged = f"rows/merged-{batch_id}-{level + 1}"
            self._write(spark.read.parquet(*[f"{self.root}/{n}" for n in full]), merged)
            folders = [[n, at] for n, at in folders if at != level] + [[merged, level + 1]]
            gone, level = gone + full, level + 1
        dropped = {**state["dropped"], **({str(version): gone} if gone else {})}
        due = [v for v in dropped if int(v) <= version - KEPT]
        self.manifest.commit(spark, version, {
            "through": batch_id, "folders": folders, "dropped": {v: n for v, n in dropped.items() if v not in due}})
        for v in due:
            for n in dropped[v]:
                self.manifest.delete(spark, n)

    __call__ = put

    def folders(self, spark: SparkSession) -> list[str]:
        return [f"{self.root}/{n}" for n, _ in self.state(spark)[1]["folders"]]

    def read(self, spark: SparkSession) -> DataFrame:
        """The current rows; there must have been a batch that was not skipped."""
        return self._current(spark.read.parquet(*self.folders(spark))).drop(BATCH)
