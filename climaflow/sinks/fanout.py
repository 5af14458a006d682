"""One micro-batch to several sinks, each failure on its own, and failed writes driven again from a sink that has the rows.

Outcomes are a log: the newest row per batch and sink tells whether the rows are there, and how often that was tried. A
batch that a sink has refused is read back from another one, and written to the sink under its own folder, so trying
again replaces what a failed attempt has left. That happens before each new batch, and on request. A batch that no sink
has taken is not committed: the stream stops and brings it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .manifest import Manifest
from .merged import MergedTable
from .tables import append_csv, append_parquet, append_table

Write = Callable[[DataFrame, str], None]
Read = Callable[[SparkSession, str], DataFrame]

OUTCOME = "batch bigint, sink string, ok boolean, error string, attempts int"
# Batches that are driven again before a new one, oldest first; the rest waits for the next.
REDO_BATCHES = 20


def storage_sinks(root: str) -> dict[str, Write]:
    """Table, CSV and Parquet sinks below ``root``, one folder per batch and sink."""
    return {
        "table": lambda df, b: append_table(df, f"{root}/table/{b}", "overwrite"),
        "csv": lambda df, b: append_csv(df, f"{root}/csv/{b}", "overwrite"),
        "parquet": lambda df, b: append_parquet(df, f"{root}/parquet/{b}", mode="overwrite"),
    }


class FanOut:
    """Batch callback that writes a batch to every sink and logs each outcome.

    The batch is kept on executor disks while the sinks read it. With ``spare``, its rows are also written below that
    folder while any sink lacks them, and failed writes are driven again from there. The spare copy has all columns
    as they came, whatever the sinks make of them, and goes when the last sink has the batch.
    """

    def __init__(self, sinks: dict[str, Write], outcomes: str, spare: str | None = None):
        self.sinks, self.spare = sinks, spare
        self.log = MergedTable(outcomes, ["batch", "sink"], ("attempts",))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = self._redo(spark, self._pending(spark)) if self.spare else []
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            here = self._attempt(kept, batch_id, self.sinks, {})
            failed = [r for r in here if not r[2]]
            if failed and len(failed) == len(self.sinks):
                raise RuntimeError(f"no sink took batch {batch_id}: {failed[0][3]}")
            if failed and self.spare:
                kept.write.mode("overwrite").parquet(f"{self.spare}/{self._name(batch_id)}")
        finally:
            kept.unpersist()
        self.log.put(spark.createDataFrame(done + here, OUTCOME).coalesce(1), self._next(spark))
        self._tidy(spark)

    @staticmethod
    def _name(batch_id: int) -> str:
        return f"batch_id={batch_id}"

    def _next(self, spark: SparkSession) -> int:
        # The log counts its own entries: a batch can be logged again, and a redo on request has no batch.
        return self.log.through(spark) + 1

    def _attempt(self, rows: DataFrame, batch_id: int, names, tried: dict[str, int]) -> list[tuple]:
        done = []
        for name in names:
            attempts = tried.get(name, 0) + 1
            try:
                self.sinks[name](rows, self._name(batch_id))
                done.append((batch_id, name, True, None, attempts))
            except Exception as error:  # one sink must not stop the others
                done.append((batch_id, name, False, f"{type(error).__name__}: {error}", attempts))
        return done

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """Newest outcome per batch and sink."""
        return self.log.read(spark)

    def _pending(self, spark: SparkSession) -> list[tuple[int, dict[str, int]]]:
        """The oldest batches that a sink lacks, with that sink's attempts so far."""
        if self.log.through(spark) < 0:
            return []
        lacking = failed_writes(self.outcomes(spark)).where(F.col("sink").isin(list(self.sinks)))
        rows = lacking.groupBy("batch").agg(F.map_from_entries(F.collect_list(F.struct("sink", "attempts"))).alias("sinks"))
        return [(r["batch"], r["sinks"]) for r in rows.orderBy("batch").limit(REDO_BATCHES).collect()]

    def _redo(self, spark: SparkSession, pending: list[tuple[int, dict[str, int]]]) -> list[tuple]:
        done = []
        for batch_id, tried in pending:
            rows = spark.read.parquet(f"{self.spare}/{self._name(batch_id)}")
            done += self._attempt(rows, batch_id, tried, tried)
        return done

    def redo(self, spark: SparkSession) -> DataFrame:
        """Drive failed writes again now; the outcomes of these attempts."""
        if not self.spare:
            raise ValueError("a folder for spare copies is needed to drive writes again")
        done = spark.createDataFrame(self._redo(spark, self._pending(spark)), OUTCOME)
        self.log.put(done.coalesce(1), self._next(spark))
        self._tidy(spark)
        return done

    def _tidy(self, spark: SparkSession) -> None:
        """Delete spare copies of batches that every sink has."""
        if not self.spare:
            return
        files = Manifest(self.spare)
        fs, folder = files._folder(spark, "")
        if not fs.exists(folder):
            return
        lacking = {r["batch"] for r in failed_writes(self.outcomes(spark)).select("batch").distinct().collect()}
        for found in fs.listStatus(folder):
            name = found.getPath().getName()
            if name.startswith("batch_id=") and int(name[9:]) not in lacking:
                files.delete(spark, name)


def failed_writes(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(~F.col("ok"))
