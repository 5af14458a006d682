"""Sustained-condition and silence alerts on streams.

Each micro-batch runs the batch operators over its readings plus the carried ones. Per station those are the readings
of the lateness span before its newest one, and what older ones still matter: the ends of the open run, or the newest
of them. A reading that is late by no more than the span therefore counts as in batch: it can split a run or end a
silence that was reported before. What it can no longer change is written as final; the rest is provisional and
replaced by the next batch. Busy stations are combined map-side like in batch, and no row passes through Python.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.calendar import epoch_seconds
from ..operators.alerts import EXTREME_HOLD_S, SILENCE_S, extreme_temperature, silent_gaps, sustained
from ..operators.keyed import join_per_key
from ..sinks.merged import MergedTable
from .slots import Slots

# How much older than its station's newest reading a reading may come, in seconds.
LATENESS_S = 120


class _Alerts:
    """State, output and acceptance of readings that both kinds of alerts share.

    Final alerts are kept in a merged table, whose folders do not grow with the batches; provisional ones are state, which
    the next batch replaces.
    """

    # The column that tells a station's alerts apart.
    since: str

    def __init__(self, root: str, lateness_s: int):
        self.slots, self.lateness_s = Slots(f"{root}/state"), lateness_s
        self.final = MergedTable(f"{root}/alerts", ["station", self.since])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, rows = batch.sparkSession, self._readings(batch)
        before = self.slots.before(spark, "newest", batch_id)
        if before is not None:
            horizon = before.select("station", self._horizon().alias("_horizon"))
            known = join_per_key(rows, horizon, ["station"], how="left")
            in_time = F.col("_horizon").isNull() | (F.col("ts") > F.col("_horizon"))
            rows = known.where(in_time).drop("_horizon").unionByName(self.slots.before(spark, "rows", batch_id))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = rows.select("station", F.col("ts").alias("seen"))
            if before is not None:
                seen = seen.unionByName(before)
            self.slots.save(seen.groupBy("station").agg(F.max("seen").alias("seen")), "newest", batch_id)
            newest = self.slots.now(spark, "newest", batch_id)
            self._fold(rows, newest, newest.select("station", self._horizon().alias("_horizon")), batch_id)
        finally:
            rows.unpersist()

    def _readings(self, batch: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _fold(self, rows: DataFrame, newest: DataFrame, horizon: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def _horizon(self) -> Column:
        return F.timestamp_micros(F.unix_micros("seen") - self.lateness_s * 1_000_000)

    def _write(self, found: DataFrame, batch_id: int) -> None:
        found = found.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.slots.save(found.where(~F.col("final")).drop("final"), "provisional", batch_id)
            self.final.put(found.where("final").drop("final"), batch_id, skip_empty=True)
        finally:
            found.unpersist()

    def alerts(self, spark: SparkSession) -> DataFrame:
        """Final alerts of all batches and provisional ones of the last."""
        provisional = self.slots.now(spark, "provisional", self.final.through(spark))
        return self.final.read(spark).unionByName(provisional) if self.final.folders(spark) else provisional


class SustainedAlerts(_Alerts):
    """Batch callback: runs long enough to alert, updated while they last.

    ``alerts`` has ``station, started, ended, held_s``; a run is final when an unflagged reading after it is out of
    the lateness span.
    """

    since = "started"

    def __init__(self, root: str, hold_s: int = EXTREME_HOLD_S, flagged: Column | None = None, lateness_s: int = LATENESS_S):
        super().__init__(root, lateness_s)
        self.hold_s, self.flagged = hold_s, flagged

    def _readings(self, batch: DataFrame) -> DataFrame:
        flag = extreme_temperature(F.col("temp")) if self.flagged is None else self.flagged
        rows = batch.select("station", "ts", flag.alias("flag"))
        return rows.where(F.col("station").isNotNull() & F.col("ts").isNotNull() & F.col("flag").isNotNull())

    def _fold(self, rows: DataFrame, newest: DataFrame, horizon: DataFrame, batch_id: int) -> None:
        settled = F.col("ts") <= F.col("_horizon")
        placed = join_per_key(rows, horizon, ["station"])
        calm = placed.groupBy("station").agg(F.max(F.when(settled & ~F.col("flag"), F.col("ts"))).alias("_calm"))
        self.slots.save(horizon.join(calm, "station", "left"), "calm", batch_id)
        marks = self.slots.now(rows.sparkSession, "calm", batch_id)

        placed = join_per_key(rows, marks, ["station"])
        # Readings of one instant count as one.
        recent = placed.where(~settled).groupBy("station", "ts").agg(F.bool_and("flag").alias("flag"))
        after_calm = F.col("_calm").isNull() | (F.col("ts") > F.col("_calm"))
        open_run = placed.where(settled & F.col("flag") & after_calm).groupBy("station").agg(
            F.min("ts").alias("started"), F.max("ts").alias("ended"))
        ends = open_run.select("station", F.explode(F.array("started", "ended")).alias("ts"), F.lit(True).alias("flag"))
        self.slots.save(recent.unionByName(ends), "rows", batch_id)

        runs = sustained(rows, F.col("flag"), self.hold_s).join(marks, "station")
        final = F.coalesce(F.col("ended") < F.col("_calm"), F.lit(False))
        self._write(runs.select("station", "started", "ended", "held_s", final.alias("final")), batch_id)


class SilenceAlerts(_Alerts):
    """Batch callback: silences that ended, and stations silent at the stream's newest time.

    ``alerts`` has ``station, silent_from, silent_to``; ``silent_to`` is null while the station is still silent. A
    silence is final when its end is out of the lateness span. ``silent_at`` tells which stations are silent at any
    other time, without a batch; ``timers.silence_by_clock`` reports them by itself.
    """

    since = "silent_from"

    def __init__(self, root: str, limit_s: int = SILENCE_S, lateness_s: int = LATENESS_S):
        super().__init__(root, lateness_s)
        self.limit_s = limit_s

    def _readings(self, batch: DataFrame) -> DataFrame:
        return batch.select("station", "ts").where(F.col("station").isNotNull() & F.col("ts").isNotNull())

    def _fold(self, rows: DataFrame, newest: DataFrame, horizon: DataFrame, batch_id: int) -> None:
        settled = F.col("ts") <= F.col("_horizon")
        placed = join_per_key(rows, horizon, ["station"])
        # No silence fits between the first and last reading of a bucket as long as the limit.
        bucket = F.floor(epoch_seconds("ts") / self.limit_s)
        bounds = placed.where(~settled).groupBy("station", bucket.alias("_bucket")).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
        recent = bounds.select("station", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("ts"))
        anchor = placed.where(settled).groupBy("station").agg(F.max("ts").alias("ts"))
        self.slots.save(recent.unionByName(anchor), "rows", batch_id)

        closed = silent_gaps(rows, self.limit_s).join(horizon, "station").select(
            "station", "silent_from", "silent_to", (F.col("silent_to") <= F.col("_horizon")).alias("final"))
        still = open_silences(newest, self.limit_s).withColumn("final", F.lit(False))
        self._write(closed.unionByName(still), batch_id)

    def silent_at(self, spark: SparkSession, batch_id: int, now: Column | None = None) -> DataFrame:
        """Stations silent at ``now`` (an instant; by default the clock's), after the batch ``batch_id``."""
        return open_silences(self.slots.now(spark, "newest", batch_id), self.limit_s, F.current_timestamp() if now is None else now)


def open_silences(newest: DataFrame, limit_s: int, now: Column | None = None) -> DataFrame:
    """Stations whose newest reading (``seen``) is longer ago than the limit, seen from ``now`` or the newest of all."""
    now = newest.select(F.max("seen")).scalar() if now is None else now
    ago = F.unix_micros(now) - F.unix_micros("seen")
    return newest.where(ago > limit_s * 1_000_000).select(
        "station", F.col("seen").alias("silent_from"), F.lit(None).cast("timestamp").alias("silent_to")
    )
