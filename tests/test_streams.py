"""Streams in several micro-batches against the batch operators; late rows, replay, sinks."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from climaflow.operators import alerts, history, latest
from climaflow.operators.windows import WindowSpec, windowed_aggregate
from climaflow.sinks import fanout, tables
from climaflow.sources import files, wire
from climaflow.sources.events import event_stream, events, full_readings, readings
from climaflow.streaming import runtime, windows
from climaflow.streaming.alerts import SilenceAlerts, SustainedAlerts
from climaflow.streaming.snapshot import LiveState


@pytest.fixture(scope="module")
def parts(spark, small, tmp_path_factory):
    """The smallest events table in four files, oldest first."""
    root = str(tmp_path_factory.mktemp("parts"))
    e = events(spark, small).orderBy("ts", "event_id").toPandas()
    for i in range(4):
        piece = e.iloc[i * len(e) // 4: (i + 1) * len(e) // 4]
        spark.createDataFrame(piece, events(spark, small).schema).coalesce(1).write.parquet(f"{root}/p{i}")
    return root


def stream_of(spark, parts):
    return readings(event_stream(spark, f"{parts}/p*", files_per_trigger=1))


def values(df):
    cols = sorted(df.columns)
    return sorted((tuple(str(v) for v in r) for r in df.select(*[F.col(c).cast("string") for c in cols]).collect()))


def test_complete_and_update_equal_batch(spark, parts, small, tmp_path):
    want = values(windowed_aggregate(readings(events(spark, small))))
    assert values(windows.complete_result(spark, stream_of(spark, parts), WindowSpec(), f"{tmp_path}/c")) == want
    windows.run_updates(spark, stream_of(spark, parts), WindowSpec(), f"{tmp_path}/u")
    assert values(windows.update_result(spark, WindowSpec(), f"{tmp_path}/u")) == want
    assert windows.update_revisions(spark, f"{tmp_path}/u").select("batch_id").distinct().count() >= 4


def test_append_writes_closed_windows_once(spark, parts, small, tmp_path):
    windows.run_closed(spark, stream_of(spark, parts), WindowSpec(), str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/out")
    batch = windowed_aggregate(readings(events(spark, small)))
    newest = events(spark, small).agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(newest).cast("timestamp_ntz") - F.expr("INTERVAL 2 MINUTES"))
    assert values(got) == values(closed)


def test_late_rows_are_dropped(spark, parts, tmp_path):
    """Newest quarter first; older quarters then arrive behind the watermark."""
    fs = f"{tmp_path}/in"
    for name in ("p3", "p1"):
        spark.read.parquet(f"{parts}/{name}").write.parquet(f"{fs}/{name}")
        windows.run_updates(spark, readings(event_stream(spark, f"{fs}/*", files_per_trigger=1)), WindowSpec(), str(tmp_path))
    kept = windows.update_result(spark, WindowSpec(), str(tmp_path)).agg(F.sum("events")).first()[0]
    assert kept == spark.read.parquet(f"{parts}/p3").count()


def test_memory_table_holds_revisions(spark, parts):
    name = f"m{uuid.uuid4().hex[:8]}"
    writer = runtime.memory_writer(windowed_aggregate(stream_of(spark, parts), WindowSpec("1 day")), name)
    runtime.run_available(writer, spark)
    got = spark.sql(f"SELECT window_start, station, hour_of_day, events FROM {name} ORDER BY window_start DESC")
    assert got.count() >= got.select("window_start", "station", "hour_of_day").distinct().count() > 0


def test_console_sink_runs(spark, parts, small, tmp_path):
    writer = runtime.console_writer(windowed_aggregate(stream_of(spark, parts)), f"{tmp_path}/c", 3)
    query = runtime.run_available(writer, spark)
    assert sum(p["numInputRows"] for p in query.recentProgress) == events(spark, small).count()
    assert query.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming.ConsoleTable")


def test_json_stream_equals_batch(spark, small, tmp_path):
    """Events as JSON text lines, decoded on the stream."""
    wire.encode(full_readings(events(spark, small))).write.text(f"{tmp_path}/json")
    raw = spark.readStream.text(f"{tmp_path}/json")
    out = windows.complete_result(spark, wire.decode(raw), WindowSpec(), f"{tmp_path}/q")
    assert values(out) == values(windowed_aggregate(readings(events(spark, small))))


def test_sustained_and_silence_over_batches(spark, parts, small, tmp_path):
    # the table is sparse: a calm limit and hours as units give runs that cross batches
    flag = F.col("temp") < 35
    runs = SustainedAlerts(f"{tmp_path}/a", 7200, flag)
    runtime.run_available(runtime.each_batch(stream_of(spark, parts), runs, f"{tmp_path}/ca", "append"), spark)
    batch = readings(events(spark, small))
    want = alerts.sustained(batch, flag, 7200).select("station", "started", "ended")
    assert values(runs.alerts(spark).select("station", "started", "ended")) == values(want) != []

    silence = SilenceAlerts(f"{tmp_path}/s", 3600)
    runtime.run_available(runtime.each_batch(stream_of(spark, parts), silence, f"{tmp_path}/cs", "append"), spark)
    want = alerts.silent_gaps(batch, 3600).select("station", "silent_from", "silent_to")
    got = silence.alerts(spark)
    assert values(got.where("silent_to is not null")) == values(want) != []
    assert got.where("silent_to is null").count() <= 5


def fed(spark, callback, batches):
    """Runs a batch callback over given readings, one list per micro-batch."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "station string, ts string, temp double")
        callback(df.withColumn("ts", F.col("ts").cast("timestamp")), i)


def at(clock):
    return f"2024-01-01 {clock}"


def test_tied_calm_reading_of_a_later_batch_ends_a_run(spark, tmp_path):
    batches = [[("a", at("00:00:00"), 35.0), ("a", at("00:04:00"), 35.0)],
               [("a", at("00:04:00"), 20.0), ("a", at("00:06:00"), 35.0)]]
    found = SustainedAlerts(str(tmp_path), 300)
    fed(spark, found, batches)
    assert found.alerts(spark).count() == 0


def test_late_reading_splits_a_silence(spark, tmp_path):
    batches = [[("a", at("00:00:00"), 1.0), ("a", at("00:01:30"), 1.0)], [("a", at("00:00:45"), 1.0)]]
    found = SilenceAlerts(str(tmp_path), 60)
    fed(spark, found, batches[:1])
    assert found.alerts(spark).count() == 1
    fed(spark, found, batches)
    assert found.alerts(spark).count() == 0
    later = F.lit(at("00:03:00")).cast("timestamp")
    silent = found.silent_at(spark, 1, later).collect()
    assert [(r["station"], str(r["silent_from"]), r["silent_to"]) for r in silent] == [("a", at("00:01:30"), None)]


def test_stream_alerts_equal_batch_over_unordered_readings(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for station in "abc":
        t = 0
        for _ in range(300):
            t += rng.choice([0, 5, 20, 40, 70, 130])
            hot = rng.random() < 0.9
            rows.append((t + rng.uniform(0, 100), station, t, 35.0 if hot else 20.0))
    rows.sort()  # by arrival, which is up to 100 s late
    clock = lambda t: at(f"{t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}")
    data = [(s, clock(t), temp) for _, s, t, temp in rows]
    batches = [data[i:i + 150] for i in range(0, len(data), 150)]
    whole = spark.createDataFrame(data, "station string, ts string, temp double").withColumn("ts", F.col("ts").cast("timestamp"))
    runs, gaps = SustainedAlerts(f"{tmp_path}/r", 120), SilenceAlerts(f"{tmp_path}/s", 60)
    fed(spark, runs, batches)
    fed(spark, gaps, batches)
    assert values(runs.alerts(spark)) == values(alerts.sustained_extreme(whole, 120)) != []
    want = alerts.silent_gaps(whole, 60).select("station", "silent_from", "silent_to")
    assert values(gaps.alerts(spark).where("silent_to is not null")) == values(want) != []


def test_snapshot_has_readings_without_a_station(spark, small, tmp_path):
    rows = full_readings(events(spark, small)).withColumn("station", F.lit(None).cast("string"))
    state = LiveState(str(tmp_path))
    state(rows.withColumn("ts", F.col("ts").cast("timestamp")), 0)
    assert [r["total"] for r in state.snapshot(spark, 0).collect()] == [rows.count()]


def test_not_a_number_is_null_and_has_a_reason(spark):
    df = spark.createDataFrame([(1, '{"timestamp": "2024-01-01T00:00:00+00:00", "temperatura": NaN, "velocidad_viento": 2.5}')],
                               "event_id int, value string")
    row = wire.decode(df).first()
    assert row["temp"] is None and row["wind"] == 2.5
    good, bad = wire.quarantine_split(df, "event_id")
    assert good.count() == 0 and [r["reason"] for r in bad.collect()] == ["number"]


def test_trials_count_every_batch(spark, small, tmp_path):
    """More batches than the engine keeps reports of."""
    e = events(spark, small)
    e.repartitionByRange(8, "ts").sortWithinPartitions("ts").write.parquet(f"{tmp_path}/in")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        got = windows.compare_trials(spark, readings(event_stream(spark, f"{tmp_path}/in", files_per_trigger=1)), str(tmp_path), windows.TRIALS[:1], speedup=50).first()
    finally:
        spark.conf.set(key, before)
    written = windows.update_revisions(spark, f"{tmp_path}/trial-1")
    assert got["batches"] >= 8 and got["rows"] == written.count() > 0


def test_snapshot_total_counts_rows_without_an_hour(spark, small, tmp_path):
    state = LiveState(str(tmp_path))
    batch = full_readings(events(spark, small)).withColumn("ts", F.col("ts").cast("timestamp"))
    state(batch.withColumn("hour_of_day", F.when(F.col("event_id") % 10 != 0, F.col("hour_of_day"))), 0)
    assert state.snapshot(spark, 0).agg(F.sum("total")).first()[0] == batch.count()


def test_live_state_over_batches(spark, parts, small, tmp_path):
    state = LiveState(f"{tmp_path}/state")
    stream = full_readings(event_stream(spark, f"{parts}/p*", files_per_trigger=1))
    query = runtime.run_available(runtime.each_batch(stream, state, f"{tmp_path}/c", "append"), spark)
    last = runtime.last_batch_id(query)
    snap = {r["station"]: r for r in state.snapshot(spark, last).collect()}
    full = full_readings(events(spark, small))
    counts = {r["station"]: r["count"] for r in full.groupBy("station").count().collect()}
    assert {s: r["total"] for s, r in snap.items()} == counts
    series = latest.last_series(full, 60).orderBy("station", F.col("age").desc()).collect()
    for s, r in snap.items():
        want = [x["temp"] for x in series if x["station"] == s]
        assert [p["v"] for p in r["temp_series"]] == want and len(want) == 60
        assert len(r["heatmap"]) == 24 and [c["h"] for c in r["heatmap"]] == list(range(24))
        assert [x["temp"] for x in r["log"]] == want[::-1][:10]
        assert r["latest"]["temp"] == want[-1]
    means = {
        (x["station"], x["hour_of_day"]): x["avg_temp"]
        for x in full.select("station").distinct().collect()
        for x in history.heatmap_means(history.hour_heatmap(full.where(F.col("station") == x["station"]))).withColumn("station", F.lit(x["station"])).collect()
    }
    assert means == {(s, c["h"]): c["temp"] for s, r in snap.items() for c in r["heatmap"] if c["count"]}
    replayed = full_readings(spark.read.parquet(f"{parts}/p3"))
    state(replayed.withColumn("ts", F.col("ts").cast("timestamp")), 3)
    assert {r["station"]: r["total"] for r in state.snapshot(spark, 3).collect()} == counts


def test_fanout_isolates_failures_and_replays(spark, small, tmp_path):
    batch = full_readings(events(spark, small))

    def broken(df, name):
        raise OSError("disk is gone")

    sinks = {"broken": broken, **fanout.storage_sinks(str(tmp_path))}
    callback = runtime.Metered(fanout.FanOut(sinks, f"{tmp_path}/outcomes"), f"{tmp_path}/metrics")
    for _ in range(2):
        callback(batch, 0)
    outcome = {r["sink"]: (r["ok"], r["error"]) for r in callback.inner.outcomes(spark).collect()}
    assert outcome["broken"] == (False, "OSError: disk is gone")
    assert all(outcome[s][0] for s in ("table", "csv", "parquet"))
    assert fanout.failed_writes(callback.inner.outcomes(spark)).count() == 1
    n = batch.count()
    assert files.read_readings(spark, f"{tmp_path}/table/*").count() == n
    assert files.read_stored_csv(spark, f"{tmp_path}/csv/*").count() == n
    assert files.read_readings(spark, f"{tmp_path}/parquet/*").count() == n
    metric = spark.read.parquet(f"{tmp_path}/metrics").collect()
    assert len(metric) == 1 and metric[0]["rows"] == n


def test_small_files_hold_fifty_rows_and_compact(spark, small, tmp_path):
    tables.append_parquet(full_readings(events(spark, small)), f"{tmp_path}/s", 50)
    small_files = spark.read.parquet(f"{tmp_path}/s")
    assert small_files.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 50
    tables.compact(spark, f"{tmp_path}/s", f"{tmp_path}/l")
    large = spark.read.parquet(f"{tmp_path}/l")
    assert len(large.inputFiles()) == 1 and values(large) == values(small_files)


def test_table_append_adds_rows(spark, small, tmp_path):
    batch = full_readings(events(spark, small))
    for _ in range(2):
        tables.append_table(batch, str(tmp_path / "t"))
    got = files.read_readings(spark, str(tmp_path / "t"))
    assert got.count() == 2 * batch.count() and "ingested_at" in got.columns


def test_hourly_history_csv(spark, tmp_path):
    (tmp_path / "h.csv").write_text("hora,temperatura,presion\n2024-01-01 00:00:00,1.5,1010\n2024-01-01 01:00:00,,1011.5\n")
    got = files.read_hourly_history(spark, str(tmp_path / "h.csv"))
    assert files.training_scan(got, ordered=True).count() == 1
    assert history.history(got, "day").orderBy("bucket").collect()[1]["avg_pressure"] == 1011.5


def test_progress_offsets(spark):
    progress = {"sources": [{"latestOffset": {"t": {"0": 50, "1": 9}}, "endOffset": {"t": {"0": 9, "1": 9}}}]}
    assert sorted(runtime.topic_offsets(progress)) == [("t", 0, 50, 9), ("t", 1, 9, 9)]
    assert runtime.topic_offsets({"sources": [{"latestOffset": '{"t":{"0":5}}', "endOffset": None}]}) == [("t", 0, 5, 0)]
    assert alerts.backpressure(runtime.offsets_frame(spark, progress)).first()["lag"] == 41


def test_state_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with runtime.state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
