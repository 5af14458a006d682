"""Timers in the state store: files in any order, restarts, and a source that stops."""

import datetime as dt
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from climaflow.operators import alerts
from climaflow.sources.events import event_stream, events, readings
from climaflow.streaming import runtime, timers

ROW = "station string, ts timestamp, temp double"
START = dt.datetime(2024, 1, 1)


def made_up(seed=4):
    """Two stations, one with most rows; pauses, ties, nulls and hot spells; then a reading a week later that settles all."""
    rng, rows = random.Random(seed), []
    for station, step in (("hot", 7), ("calm", 40)):
        at, warm = 0.0, False
        for k in range(400 if station == "hot" else 80):
            at += rng.choice([step, step, step / 3, 0, 150 if rng.random() < 0.1 else step])
            warm = warm != (rng.random() < 0.06)
            rows.append((station, START + dt.timedelta(seconds=round(at, 3)), 35.0 if warm else 20.0))
    rows += [(None, START, 35.0), ("hot", None, 35.0), ("calm", START, None)]
    late = [(s, START + dt.timedelta(days=7), 20.0) for s in ("hot", "calm")]
    return rows, late


def write_files(spark, rows, late, folder, pieces=5, seed=1):
    rows = rows[:]
    random.Random(seed).shuffle(rows)
    for k in range(pieces):
        spark.createDataFrame(rows[k::pieces], ROW).coalesce(1).write.parquet(f"{folder}/p{k}")
    spark.createDataFrame(late, ROW).coalesce(1).write.parquet(f"{folder}/z")


def stream(spark, folder):
    return spark.readStream.schema(ROW).option("maxFilesPerTrigger", 2).parquet(f"{folder}/*")


def run(spark, found, table, root):
    return runtime.run_available(runtime.each_batch(found, table, f"{root}/checkpoint", "append"), spark, 3)


def values(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def batch(spark):
    rows, late = made_up()
    return spark.createDataFrame(rows + late, ROW).where("station is not null").cache()


def test_silences_of_shuffled_files_equal_batch_over_restarts(spark, batch, tmp_path):
    rows, late = made_up()
    table = timers.silence_table(f"{tmp_path}/found")
    write_files(spark, rows[:250], [], f"{tmp_path}/in/a", 3)
    run(spark, timers.silences(stream(spark, f"{tmp_path}/in/*"), 60, "1 day"), table, tmp_path)
    write_files(spark, rows[250:], late, f"{tmp_path}/in/b", 3)
    run(spark, timers.silences(stream(spark, f"{tmp_path}/in/*"), 60, "1 day"), table, tmp_path)
    want = alerts.silent_gaps(batch, 60).select("station", "silent_from", "silent_to").where(F.col("silent_to") < "2024-01-05")
    got = table.read(spark)
    assert values(got.where("silent_to < '2024-01-05'").select("station", "silent_from", "silent_to")) == values(want) != []
    # The newest settled reading of each station has had no successor when the watermark passed it.
    last = batch.where("ts < '2024-01-05'").groupBy("station").agg(F.max("ts").alias("silent_from"))
    assert values(got.where("silent_to is null").select("station", "silent_from")) == values(last)


def test_runs_of_shuffled_files_equal_batch_over_restarts(spark, batch, tmp_path):
    rows, late = made_up()
    table = timers.run_table(f"{tmp_path}/found")
    write_files(spark, rows[:250], [], f"{tmp_path}/in/a", 3)
    run(spark, timers.sustained_runs(stream(spark, f"{tmp_path}/in/*"), None, 60, "1 day"), table, tmp_path)
    write_files(spark, rows[250:], late, f"{tmp_path}/in/b", 3)
    run(spark, timers.sustained_runs(stream(spark, f"{tmp_path}/in/*"), None, 60, "1 day"), table, tmp_path)
    want = alerts.sustained_extreme(batch.where("ts < '2024-01-05'"), 60)
    got = table.read(spark)
    assert values(got.select("station", "started", "ended", "held_s")) == values(want) != []


def test_stopped_source_alerts_by_itself(spark, tmp_path):
    """No file, no batch of data and no call after the readings: the clock alone."""
    rows = [(s, START + dt.timedelta(seconds=k), 20.0) for k in range(50) for s in ("a", "b")] + [(None, START, 1.0)]
    spark.createDataFrame(rows, ROW).coalesce(1).write.parquet(f"{tmp_path}/in/p0")
    table = timers.silence_table(f"{tmp_path}/found")
    found = timers.silence_by_clock(stream(spark, f"{tmp_path}/in"), 2)
    query = runtime.start_every(runtime.each_batch(found, table, f"{tmp_path}/checkpoint", "append"), spark, "500 milliseconds", 2)
    try:
        open_ones = lambda: table.read(spark).where("silent_to is null")
        timers.wait_for(lambda: table.through(spark) >= 0 and open_ones().count() == 3, query)
        end = START + dt.timedelta(seconds=49)
        assert {(r["station"], str(r["silent_from"])) for r in open_ones().collect()} == {(s, str(end)) for s in ("a", "b", "*")}
        # A reading ends the silence of its station and of the source.
        spark.createDataFrame([("a", START + dt.timedelta(seconds=90), 20.0)], ROW).coalesce(1).write.parquet(f"{tmp_path}/new")
        (tmp_path / "new").rename(tmp_path / "in" / "p1")
        closed = lambda: table.read(spark).where("silent_to is not null")
        timers.wait_for(lambda: closed().count() == 2, query)
        assert {(r["station"], str(r["silent_to"])) for r in closed().collect()} == {(s, str(START + dt.timedelta(seconds=90))) for s in ("a", "*")}
    finally:
        query.stop()
    assert query.lastProgress is not None


def test_state_of_a_station_that_is_gone_is_dropped(spark, tmp_path):
    rows = [("a", START + dt.timedelta(seconds=k), 35.0) for k in range(0, 200, 10)]
    later = [("b", START + dt.timedelta(days=20), 20.0)]
    back = [("a", START + dt.timedelta(days=20, seconds=5), 35.0), ("b", START + dt.timedelta(days=40), 20.0)]
    for k, part in enumerate((rows, later, back)):
        spark.createDataFrame(part, ROW).coalesce(1).write.parquet(f"{tmp_path}/in/p{k}")
        time.sleep(0.02)
    one = lambda: spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    runs = timers.run_table(f"{tmp_path}/runs")
    run(spark, timers.sustained_runs(one(), None, 60, "1 hour", forget_s=86400), runs, f"{tmp_path}/r")
    assert [(r["station"], r["held_s"], r["final"]) for r in runs.read(spark).collect()] == [("a", 190.0, True)]
    gaps = timers.silence_table(f"{tmp_path}/gaps")
    run(spark, timers.silences(one(), 60, "1 hour", forget_s=86400), gaps, f"{tmp_path}/s")
    # What comes back after it was forgotten is new, so its silence has no end.
    got = gaps.read(spark).where("station = 'a'").orderBy("silent_from").collect()
    assert [r["silent_to"] for r in got] == [None, None]


def test_empty_stream(spark, tmp_path):
    spark.createDataFrame([], ROW).write.parquet(f"{tmp_path}/in/p0")
    table = timers.silence_table(f"{tmp_path}/found")
    run(spark, timers.silences(stream(spark, f"{tmp_path}/in"), 60), table, tmp_path)
    assert table.through(spark) == -1 or table.read(spark).count() == 0


def test_busy_station_is_combined_before_the_shuffle(spark, small):
    bounds = timers._bucket_bounds(readings(events(spark, small)), 86400 * 365)
    assert bounds.count() <= 5 * bounds.rdd.getNumPartitions() and bounds.agg(F.max("hi")).first()[0] is not None
    assert event_stream(spark, f"{small}/events*.parquet").isStreaming


def _long_runs(us, flag, hold):
    found, began, ended = [], None, None
    for at in sorted(set(us)):
        if all(f for u, f in zip(us, flag) if u == at):
            began, ended = at if began is None else began, at
            continue
        found.append((began, ended))
        began = ended = None
    return [(a, b) for a, b in [*found, (began, ended)] if a is not None and b - a >= hold]


def test_pruned_instants_keep_every_long_run():
    rng = np.random.default_rng(5)
    for share in (0.1, 0.5, 0.9, 0.97, 1.0):
        us, flag = rng.integers(-2000, 4000, 700), rng.random(700) < share
        left = [x[1:] for x in [timers._pruned(np.zeros(700, np.int64), us, flag, 40)]][0]
        assert _long_runs(*(x.tolist() for x in left), 40) == _long_runs(us.tolist(), flag.tolist(), 40)


def test_flagged_instants_are_combined_over_the_batches_of_a_task():
    us = np.arange(100_000, dtype=np.int64) * 1_000_000
    batches = [pa.record_batch([pa.array(["a"] * 100), pa.array(us[k:k + 100]), pa.array(us[k:k + 100] // 1_000_000 % 10 != 0)],
                               names=["station", "us", "flag"]) for k in range(0, len(us), 100)]
    sent = pa.Table.from_batches(timers._instants(1000)(iter(batches)))
    # Per bucket of the hold the first and last unflagged instant, and nine flagged ones after it.
    assert sent.num_rows == 100 * 11
