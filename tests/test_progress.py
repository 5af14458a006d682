"""Engine reports as a table, triggers of trials, landed payloads, long gaps."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from climaflow.operators import hourly
from climaflow.operators.windows import WindowSpec
from climaflow.sources import payload
from climaflow.sources.events import event_stream, events, readings
from climaflow.streaming import progress, runtime, windows


def report(batch, ends, reached, rows=10, query="q"):
    return {"id": query, "batchId": batch, "timestamp": f"2024-01-01T00:00:{batch:02d}.000Z", "numInputRows": rows, "processedRowsPerSecond": 5.0,
            "durationMs": {"triggerExecution": 20}, "stateOperators": [{"numRowsTotal": 3, "numRowsDroppedByWatermark": 1}],
            "eventTime": {"watermark": "2024-01-01T00:00:00.000Z"},
            "sources": [{"latestOffset": json.dumps({"t": ends}), "endOffset": json.dumps({"t": reached})}]}


def test_lag_and_backpressure_of_every_batch(spark, tmp_path):
    table = progress.ProgressTable(spark, str(tmp_path))
    table.add(report(0, {"0": 100, "1": 50}, {"0": 100, "1": 50}))
    table.add(report(1, {"0": 1000, "1": 50}, {"0": 100, "1": 40}), report(1, {"0": 7, "1": 7}, {"0": 0, "1": 0}, query="other"))
    table.add(report(2, {"0": 1000, "1": 60}, {"0": 1000}, rows=0))
    got = {(r["query"], r["batch"], r["topic"]): (r["lag"], r["alert"]) for r in progress.backpressure_by_batch(table.read(spark)).collect()}
    assert got == {("q", 0, "t"): (0, False), ("q", 1, "t"): (910, True), ("other", 1, "t"): (14, False), ("q", 2, "t"): (60, True)}
    parts = {(r["batch"], r["partition"]): r["lag"] for r in progress.lag(table.read(spark)).where("query = 'q'").collect()}
    assert parts == {(0, 0): 0, (0, 1): 0, (1, 0): 900, (1, 1): 10, (2, 0): 0, (2, 1): 60}
    first = table.read(spark).where("batch = 0").first()
    assert (first["rows"], first["rows_per_s"], first["batch_ms"], first["state_rows"], first["late_rows"]) == (10, 5.0, 20, 3, 1)


def test_engine_pushes_a_row_per_batch(spark, small, tmp_path):
    e = events(spark, small)
    e.repartitionByRange(3, "ts").write.parquet(f"{tmp_path}/in")
    table = progress.ProgressTable(spark, f"{tmp_path}/table")
    with progress.listening(spark, table):
        query = windows.run_current(spark, readings(event_stream(spark, f"{tmp_path}/in", files_per_trigger=1)), WindowSpec(), str(tmp_path))
        table.wait_for_batch(query, runtime.last_batch_id(query))
    got = table.read(spark)
    assert got.agg(F.sum("rows")).first()[0] == e.count()
    assert got.where("rows > 0").count() == 3 and got.where("rows > 0 and batch_ms is null").count() == 0
    assert got.where("rows > 0 and size(partitions) > 0").count() == 0  # files have no partitions


def test_errors_of_the_listener_are_told(spark, tmp_path):
    table = progress.ProgressTable(spark, str(tmp_path))

    class Broken:
        class progress:
            json = "{"

    table.onQueryProgress(Broken())
    with pytest.raises(ValueError):
        table.read(spark)


def test_intervals():
    assert runtime.interval("10 seconds") == "10000 milliseconds" and runtime.interval("60 seconds", 20) == "3000 milliseconds"
    with pytest.raises(ValueError):
        runtime.interval("1 minute")


def test_trials_wait_for_their_trigger(spark, small, tmp_path):
    """Three files, one per batch: batches begin a trigger apart."""
    events(spark, small).repartitionByRange(3, "ts").write.parquet(f"{tmp_path}/in")
    table = progress.ProgressTable(spark, f"{tmp_path}/table")
    trial = windows.Trial(9, "40 seconds", "1 minute", "5 minutes")
    with progress.listening(spark, table):
        got = windows.run_trial(spark, readings(event_stream(spark, f"{tmp_path}/in", files_per_trigger=1)), trial, str(tmp_path), speedup=10).collect()
        until = dt.datetime.now() + dt.timedelta(seconds=30)
        while table.table.through(spark) < 0 or table.read(spark).where("rows > 0").count() < 3:
            assert dt.datetime.now() < until
    began = [r["at"] for r in table.read(spark).where("rows > 0").orderBy("batch").collect()]
    assert len(got) >= 3
    assert all((b - a).total_seconds() >= 3.5 for a, b in zip(began, began[1:]))


def test_landed_payloads_are_read(spark, tmp_path):
    doc = {"name": "x", "sys": {"country": "PE"}, "coord": {"lat": 1.0, "lon": 2.0},
           "main": {"temp": 20.5, "feels_like": 20.0, "temp_min": 19.0, "temp_max": 21.0, "humidity": 40, "pressure": 1000},
           "weather": [{"description": "cielo claro"}], "clouds": {"all": 5}, "wind": {"speed": 2.5}, "visibility": 9000}
    (tmp_path / "a.json").write_text(json.dumps(doc) + "\n" + json.dumps({**doc, "name": "y"}) + "\n")
    (tmp_path / "b.json").write_text("not json\n")
    got = payload.read_payloads(spark, str(tmp_path))
    flat = payload.flatten_payload(got, F.lit("2024-01-01").cast("timestamp"))
    assert {r["station"] for r in flat.where("temp = 20.5").collect()} == {"x", "y"}


def test_a_gap_of_two_hundred_years(spark):
    rows = [("a", dt.datetime(1824, 1, 1), 0.0), ("a", dt.datetime(2024, 1, 1), 200.0), ("a", dt.datetime(2024, 1, 1, 5), 5.0), ("b", dt.datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "station string, hr timestamp_ntz, temp double")
    got = hourly.interpolate_hours(df)
    hours = int((dt.datetime(2024, 1, 1, 5) - dt.datetime(1824, 1, 1)).total_seconds() // 3600) + 1
    one = got.where("station = 'a'").agg(F.count("*").alias("n"), F.countDistinct("hr").alias("d"), F.count("temp").alias("t"), F.min("hr").alias("lo"), F.max("hr").alias("hi")).first()
    assert (one["n"], one["d"], one["t"], one["lo"], one["hi"]) == (hours, hours, hours, rows[0][1], rows[2][1])
    middle = got.where(F.col("hr") == F.lit("1924-01-01").cast("timestamp_ntz")).first()
    assert abs(middle["temp"] - 100) < 0.1 and middle["filled"]
    assert [(r["temp"], r["filled"]) for r in got.where("station = 'b'").collect()] == [(None, True)]
