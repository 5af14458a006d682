"""Streaming queries over the events table as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fixedpoint import hundredths
from ..operators.alerts import SILENCE_S
from ..operators.windows import WindowSpec, newest_first
from ..schema import naive_timestamps
from ..session import run_dir
from ..sinks import fanout, tables
from ..sources import files
from ..sources.events import event_stream, events, full_readings, readings
from ..streaming import alerts as live_alerts, progress, runtime, timers, windows
from ..streaming.snapshot import LiveState


def _stream(spark: SparkSession, path: str) -> DataFrame:
    return readings(event_stream(spark, path))


def _events_path(d: str) -> str:
    return f"{d}/events*.parquet"


def _add_part(spark, d, root: str, number: int, of: int, name: str) -> None:
    """Write one of ``of`` equal time slices of events as a folder the stream watches."""
    e = events(spark, d)
    first, last = e.select(F.min("ts")).scalar(), e.select(F.max("ts")).scalar()
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    slot = F.least(F.floor((us(F.col("ts")) - us(first)) * of / (us(last) - us(first))), F.lit(of - 1))
    e.where(slot == number).write.mode("overwrite").parquet(f"{root}/in/{name}")


def _watch(spark, root: str) -> DataFrame:
    return readings(event_stream(spark, f"{root}/in/*", files_per_trigger=100000))


def stream_window_complete(spark, d):
    """Complete mode over the whole table equals the batch aggregate."""
    root = run_dir(spark, "complete")
    return naive_timestamps(windows.complete_result(spark, _stream(spark, _events_path(d)), WindowSpec(), root))


def stream_update_latest(spark, d):
    """Update mode: the newest revision of every window, newest window first."""
    root = run_dir(spark, "update")
    windows.run_current(spark, _stream(spark, _events_path(d)), WindowSpec(), root)
    return naive_timestamps(newest_first(windows.current_windows(WindowSpec(), root).read(spark)))


def stream_restart(spark, d):
    """Two runs on one checkpoint, new files in between: nothing lost, nothing counted twice."""
    root = run_dir(spark, "restart")
    for part in range(2):
        _add_part(spark, d, root, part, 2, f"part{part}")
        windows.run_current(spark, _watch(spark, root), WindowSpec(), root)
    return naive_timestamps(windows.current_windows(WindowSpec(), root).read(spark))


def stream_late_drop(spark, d):
    """Quarters of the table arriving in the order 1, 4, 3, 2 under a two-minute watermark."""
    root = run_dir(spark, "late")
    for part in (0, 3, 2, 1):
        _add_part(spark, d, root, part, 4, f"part{part}")
        windows.run_updates(spark, _watch(spark, root), WindowSpec(), root)
    return naive_timestamps(windows.update_result(spark, WindowSpec(), root))


def stream_param_sweep(spark, d):
    """The trials at their triggers, twenty times as fast."""
    root = run_dir(spark, "trials")
    return windows.compare_trials(spark, _stream(spark, _events_path(d)), root, speedup=20)


def stream_trial_rows(spark, d):
    """Settings and result rows of the trials; a table of one file is one batch, which writes each window once."""
    return stream_param_sweep(spark, d).select("trial", "trigger", "watermark", "window_width", "rows")


def _snapshot_state(spark, d):
    root = run_dir(spark, "snapshot")
    state = LiveState(f"{root}/state")
    stream = full_readings(event_stream(spark, _events_path(d)))
    query = runtime.run_available(runtime.each_batch(stream, state, f"{root}/checkpoint", "append"), spark)
    return state, runtime.last_batch_id(query)


def stream_snapshot(spark, d):
    """Live snapshot document per station after the last batch."""
    state, last = _snapshot_state(spark, d)
    return state.snapshot_json(spark, last)


def stream_snapshot_heatmap(spark, d):
    """Hour heat map of the live state."""
    state, last = _snapshot_state(spark, d)
    return state.heatmap(spark, last)


def stream_sustained(spark, d):
    """Sustained extreme temperature on the stream equals the batch result."""
    root = run_dir(spark, "sustained")
    found = live_alerts.SustainedAlerts(root)
    runtime.run_available(runtime.each_batch(_stream(spark, _events_path(d)), found, f"{root}/checkpoint", "append"), spark)
    return naive_timestamps(found.alerts(spark))


def stream_silence(spark, d):
    """Silences that ended, and stations silent when the stream stops."""
    root = run_dir(spark, "silence")
    found = live_alerts.SilenceAlerts(root, SILENCE_S)
    runtime.run_available(runtime.each_batch(_stream(spark, _events_path(d)), found, f"{root}/checkpoint", "append"), spark)
    return naive_timestamps(found.alerts(spark))


# Pairs of neighbouring sixths of the table arrive in the wrong order, one file per batch.
SHUFFLED, SHUFFLED_DELAY = (1, 0, 3, 2, 5, 4), "11 days"


def _shuffled_stream(spark, d, root: str) -> DataFrame:
    for place, part in enumerate(SHUFFLED):
        _add_part(spark, d, root, part, len(SHUFFLED), f"part{place}")
    return readings(event_stream(spark, f"{root}/in/*", files_per_trigger=1))


def stream_silence_timers(spark, d):
    """Ended silences of ten minutes by event-time timers, from files in the wrong order."""
    root = run_dir(spark, "silence-timers")
    found = timers.silence_table(f"{root}/found")
    stream = timers.silences(_shuffled_stream(spark, d, root), 600, SHUFFLED_DELAY)
    runtime.run_available(runtime.each_batch(stream, found, f"{root}/checkpoint", "append"), spark)
    return naive_timestamps(found.read(spark).where(F.col("silent_to").isNotNull()))


def stream_sustained_timers(spark, d):
    """Two hours below 35 degrees by event-time timers, from files in the wrong order."""
    root = run_dir(spark, "sustained-timers")
    found = timers.run_table(f"{root}/found")
    stream = timers.sustained_runs(_shuffled_stream(spark, d, root), F.col("temp") < 35, 7200, SHUFFLED_DELAY)
    runtime.run_available(runtime.each_batch(stream, found, f"{root}/checkpoint", "append"), spark)
    return naive_timestamps(found.read(spark).drop("final"))


def stream_silence_clock(spark, d):
    """Stations, and the whole source, that have stopped: reported by the clock while the query waits for more."""
    root = run_dir(spark, "silence-clock")
    found = timers.silence_table(f"{root}/found")
    stream = timers.silence_by_clock(_stream(spark, _events_path(d)), 2)
    query = runtime.start_every(runtime.each_batch(stream, found, f"{root}/checkpoint", "append"), spark, "1 second")
    stations = events(spark, d).where(F.col("event_type").isNotNull() & F.col("ts").isNotNull()).select("event_type").distinct().count()
    try:
        timers.wait_for(lambda: found.through(spark) >= 0 and found.read(spark).where(F.col("silent_to").isNull()).count() > stations, query)
    finally:
        query.stop()
    return naive_timestamps(found.read(spark).where(F.col("silent_to").isNull()).select("station", "silent_from"))


def stream_progress(spark, d):
    """Rows read by every batch that had any, as the engine reported them."""
    root = run_dir(spark, "progress")
    table = progress.ProgressTable(spark, f"{root}/table")
    with progress.listening(spark, table):
        query = windows.run_current(spark, _stream(spark, _events_path(d)), WindowSpec(), root)
        table.wait_for_batch(query, runtime.last_batch_id(query))
    return table.read(spark).where("rows > 0").select("batch", "rows")


def sink_fanout(spark, d):
    """Readings to table, CSV and Parquet files; rows and sums read back from each."""
    root = run_dir(spark, "fanout")
    stream = full_readings(event_stream(spark, _events_path(d)))
    callback = fanout.FanOut(fanout.storage_sinks(root), f"{root}/outcomes")
    runtime.run_available(runtime.each_batch(stream, callback, f"{root}/checkpoint", "append"), spark)
    table = files.read_readings(spark, f"{root}/table/*")
    csv = files.read_stored_csv(spark, f"{root}/csv/*")
    parquet = files.to_engine_names(files.read_readings(spark, f"{root}/parquet/*"))
    return _read_back({"table": table, "csv": csv, "parquet": parquet})


def _read_back(sinks: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.select(F.lit(name).alias("sink"), "station", hundredths("temp").alias("c"), "humidity", "ts_raw")
        for name, df in sinks.items()
    ]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return merged.groupBy("sink", "station").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("c").alias("temp_sum"),
        F.sum("humidity").alias("humidity_sum"), F.max("ts_raw").alias("newest"),
    )


def parquet_compact(spark, d):
    """Many small files rewritten as few large ones, read back."""
    root = run_dir(spark, "compact")
    pieces = 8 * spark.sparkContext.defaultParallelism
    tables.append_parquet(full_readings(events(spark, d)).repartition(pieces), f"{root}/small")
    tables.compact(spark, f"{root}/small", f"{root}/large")
    return _read_back({"large": files.to_engine_names(files.read_readings(spark, f"{root}/large"))})


def csv_roundtrip(spark, d):
    root = run_dir(spark, "csv")
    tables.append_csv(full_readings(events(spark, d)), f"{root}/csv")
    return files.read_stored_csv(spark, f"{root}/csv")


QUERIES = {
    "stream_window_complete": stream_window_complete,
    "stream_update_latest": stream_update_latest,
    "stream_restart": stream_restart,
    "stream_late_drop": stream_late_drop,
    "stream_param_sweep": stream_param_sweep,
    "stream_trial_rows": stream_trial_rows,
    "stream_snapshot": stream_snapshot,
    "stream_snapshot_heatmap": stream_snapshot_heatmap,
    "stream_sustained": stream_sustained,
    "stream_silence": stream_silence,
    "stream_silence_timers": stream_silence_timers,
    "stream_sustained_timers": stream_sustained_timers,
    "stream_silence_clock": stream_silence_clock,
    "stream_progress": stream_progress,
    "sink_fanout": sink_fanout,
    "parquet_compact": parquet_compact,
    "csv_roundtrip": csv_roundtrip,
}
