"""Live state after every batch: totals, hour heat map, recent series, log, latency."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import clock_text
from ..functions.fixedpoint import exact_sum, half_up_ratio, mean_of, usable
from ..operators.keyed import join_null_safe
from ..operators.latest import top_k
from .slots import Slots

SERIES, LOG, LATENCIES = 60, 10, 20
TAIL_COLUMNS = ["station", "ts", "event_id", "ts_raw", "temp", "humidity", "wind", "pressure", "description"]


class LiveState:
    """Batch callback that folds a micro-batch into the state of the batch before.

    State is small whatever the stream's volume: 24 hour sums and the newest 60 rows per
    station.
    """

    def __init__(self, root: str):
        self.slots = Slots(root)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, began = batch.sparkSession, time.time()
        heat = batch.groupBy("station", "hour_of_day").agg(
            exact_sum("temp").alias("s"), F.count(usable("temp")).alias("k"), F.count(F.lit(1)).alias("n"),
        )
        tail = top_k(batch.select(*TAIL_COLUMNS), ["station"], self._newest(), SERIES, "age").drop("age")
        recent = self.slots.before(spark, "latency", batch_id)
        if recent is not None:
            heat = heat.unionByName(self.slots.before(spark, "heat", batch_id))
            heat = heat.groupBy("station", "hour_of_day").agg(*[F.sum(c).alias(c) for c in ("s", "k", "n")])
            tail = tail.unionByName(self.slots.before(spark, "tail", batch_id))
            tail = top_k(tail, ["station"], self._newest(), SERIES, "age").drop("age")
        self.slots.save(heat, "heat", batch_id)
        self.slots.save(tail, "tail", batch_id)
        took = spark.range(1).select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(int((time.time() - began) * 1000)).cast("bigint").alias("latency_ms"),
        )
        latencies = took if recent is None else took.unionByName(recent)
        latencies = latencies.orderBy(F.col("batch_id").desc()).limit(LATENCIES)
        self.slots.save(latencies, "latency", batch_id)
        self.slots.save(self.assemble(spark, batch_id), "snapshot", batch_id)

    @staticmethod
    def _newest() -> list:
        return [F.col("ts").desc(), F.col("event_id").desc()]

    def heatmap(self, spark: SparkSession, batch_id: int) -> DataFrame:
        heat = self.slots.now(spark, "heat", batch_id)
        return heat.select("station", "hour_of_day", mean_of("s", "k").alias("avg_temp"), F.col("n").alias("events"))

    def assemble(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """One row per station with its dense heat map, series, log and latest event."""
        cells = self.heatmap(spark, batch_id)
        grid = cells.select("station").distinct().withColumn(
            "hour_of_day", F.explode(F.sequence(F.lit(0), F.lit(23)))
        )
        dense = join_null_safe(grid, cells, ["station", "hour_of_day"], "left")
        cell = F.struct(
            F.col("hour_of_day").alias("h"), F.col("avg_temp").alias("temp"),
            F.coalesce("events", F.lit(0)).alias("count"),
        )
        # Rows without an hour are in no cell of the grid but count in the total.
        totals = cells.groupBy("station").agg(F.sum("events").alias("total"))
        maps = join_null_safe(dense.groupBy("station").agg(F.sort_array(F.collect_list(cell)).alias("heatmap")), totals, ["station"])
        tail = self.slots.now(spark, "tail", batch_id).withColumn("clock", clock_text("ts_raw"))
        entry = F.struct("ts", "event_id", "clock", "temp", "humidity", "wind", "pressure", "description")
        rows = tail.groupBy("station").agg(F.sort_array(F.collect_list(entry)).alias("rows"))

        def series(field: str):
            return F.transform("rows", lambda r: F.struct(r["clock"].alias("ts"), r[field].alias("v")))

        log = F.slice(F.reverse("rows"), 1, LOG)
        lat = self.slots.now(spark, "latency", batch_id).agg(
            F.sum("latency_ms").alias("ms"), F.count(F.lit(1)).alias("n")
        ).select(half_up_ratio("ms", "n", 1).alias("mean_latency_ms"))
        return (
            join_null_safe(maps, rows, ["station"])
            .withColumn("mean_latency_ms", lat.scalar())
            .select(
                "station",
                F.lit(batch_id).cast("bigint").alias("batch_id"),
                "total",
                "mean_latency_ms",
                F.element_at("rows", -1).alias("latest"),
                "heatmap",
                series("temp").alias("temp_series"),
                series("humidity").alias("humidity_series"),
                series("wind").alias("wind_series"),
                series("pressure").alias("pressure_series"),
                log.alias("log"),
            )
        )

    def snapshot(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.slots.now(spark, "snapshot", batch_id)

    def snapshot_json(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The snapshot as one JSON document per station."""
        snap = self.snapshot(spark, batch_id)
        return snap.select("station", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("snapshot"))
