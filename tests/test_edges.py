"""Edge rows: parsing, rounding, windows, periods, gaps, runs, metrics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from climaflow.functions import bands, calendar as cal
from climaflow.functions.fixedpoint import half_up_ratio
from climaflow.operators import alerts, counters, describe, history, hourly, keyed, latest, ordered, pipeline_metrics
from climaflow.operators.windows import WindowSpec, windowed_aggregate
from climaflow.sources import kafka, payload, wire


def at(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_decode_edge_rows(spark):
    texts = [
        (1, '{bad'),
        (2, '{"timestamp":"2026-06-22T10:05:07.123456-05:00","temperatura":1,"humedad":"a"}'),
        (3, '{"timestamp":"2026-06-22T10:05:07-05:00","temperatura":"1.5","humedad":60.0}'),
        (4, '{"timestamp":"nope","temperatura":2.5,"humedad":7}'),
        (5, '{"timestamp":"2026-06-22T10:05:07-05:00","temperatura":2.5,"humedad":7,"extra":1}'),
    ]
    df = spark.createDataFrame(texts, "event_id int, value string")
    got = {r["event_id"]: r for r in wire.decode(df.withColumn("value", F.col("value").cast("binary")), None, "event_id").collect()}
    assert got[1]["temp"] is None and got[1]["ts"] is None
    assert got[2]["temp"] == 1.0 and got[2]["humidity"] is None
    assert got[2]["ts"].astimezone(dt.timezone.utc).replace(tzinfo=None) == at("2026-06-22T15:05:07.123456")
    assert got[3]["temp"] is None and got[3]["humidity"] is None
    assert got[4]["ts"] is None and got[4]["temp"] == 2.5
    good, bad = wire.quarantine_split(df, "event_id")
    assert [r["event_id"] for r in good.collect()] == [5]
    reasons = {r["event_id"]: r["reason"] for r in bad.collect()}
    assert reasons == {1: "corrupt", 2: "corrupt", 3: "corrupt", 4: "timestamp"}
    assert {r["raw"] for r in bad.collect()} == {t for i, t in texts if i != 5}


def test_reduced_schema_ignores_other_fields(spark):
    df = spark.createDataFrame([('{"timestamp":"2026-01-01T00:00:00Z","presion":9,"temperatura":3.0}',)], "value string")
    out = wire.decode(df, ["ts_raw", "temp"])
    assert out.columns == ["ts_raw", "temp", "ts"] and out.first()["temp"] == 3.0


def test_encode_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "station string, temp double")
    assert wire.encode(df).first()["value"] == '{"ciudad":"a","temperatura":null}'


def test_payload_without_optional_parts(spark):
    doc = '{"name":"x","main":{"temp":1.005,"humidity":5},"weather":[],"wind":{"speed":2.345}}'
    df = spark.createDataFrame([(doc,)], "value string")
    r = payload.flatten_payload(df, F.lit("2024-12-30 05:00:00").cast("timestamp")).first()
    assert (r["temp"], r["wind"], r["visibility"], r["description"], r["lat"]) == (1.01, 2.35, 0, None, None)
    assert (r["hour_of_day"], r["day_of_week"]) == (5, 0)


def test_kafka_options():
    assert kafka.read_options("h:1", "t")["startingOffsets"] == "latest"
    assert kafka.read_options("h:1", "t", replay=True)["startingOffsets"] == "earliest"
    assert kafka.read_options("h:1", "t")["failOnDataLoss"] == "false"
    assert kafka.write_options("h:1", "t")["kafka.acks"] == "all"
    assert kafka.write_options("h:1", "t")["kafka.retries"] == "3"


def test_kafka_tail(spark):
    df = spark.createDataFrame([(3, 7, bytearray(b'{"timestamp":"2026-01-01T00:00:00Z","temperatura":3.5}'))],
                               "partition int, offset long, value binary")
    r = kafka.tail(df).first()
    assert (r["partition"], r["offset"], r["temp"]) == (3, 7, 3.5)


@pytest.mark.parametrize("num,den,digits,want", [
    (5, 2, 0, 3.0), (-5, 2, 0, -3.0), (1, 3, 2, 0.33), (2, 3, 2, 0.67), (-1, 1000, 2, 0.0), (1, 0, 2, None), (125, 1000, 2, 0.13),
])
def test_half_up(spark, num, den, digits, want):
    assert spark.range(1).select(half_up_ratio(str(num), str(den), digits)).first()[0] == want


def readings_df(spark, data):
    return spark.createDataFrame(data, "event_id long, station string, ts timestamp_ntz, temp double")


def test_window_edge_and_null_time(spark):
    df = readings_df(spark, [(1, "a", at("2024-01-01T10:05:00"), 1.0), (2, "a", None, 9.0), (3, "a", at("2024-01-01T10:09:59"), 2.0)])
    df = df.withColumn("hour_of_day", F.hour("ts"))
    out = windowed_aggregate(df, WindowSpec(measures=("avg_temp", "events"))).collect()
    assert [(r["window_start"], r["window_end"], r["avg_temp"], r["events"]) for r in out] == [
        (at("2024-01-01T10:05:00"), at("2024-01-01T10:10:00"), 1.5, 2)
    ]


def test_heatmap_nulls_zero_and_empty_hours(spark):
    df = readings_df(spark, [
        (1, "a", at("2024-01-01T01:00:00"), 0.0), (2, "a", at("2024-01-01T01:10:00"), None), (3, "a", at("2024-01-01T02:00:00"), None),
    ])
    got = {(r["period"], r["hour"]): (r["avg_temp"], r["events"]) for r in history.heatmaps(df).collect()}
    assert len(got) == 96
    assert got[("day", 1)] == (0.0, 2) and got[("day", 2)] == (None, 1) and got[("year", 3)] == (None, 0)


def test_periods_start_at_the_time_of_day(spark):
    newest = at("2024-03-31T12:00:00")
    data = [(i, "a", newest - dt.timedelta(days=i), float(i)) for i in range(40)]
    data.append((99, "a", newest - dt.timedelta(days=7, seconds=1), 50.0))
    df = readings_df(spark, data).withColumn("pressure", F.lit(1000))
    assert history.history(df, "week").count() == 8
    assert history.history(df, "month").count() == 31
    assert history.history(df, "day").count() == 1
    assert history.history(df, "year").count() == 2
    assert {r["label"] for r in history.history(df, "year").collect()} == {"Feb 2024", "Mar 2024"}
    with pytest.raises(ValueError):
        history.history(df, "decade")


def test_empty_table(spark):
    df = readings_df(spark, []).withColumn("pressure", F.lit(1))
    assert history.history(df, "week").count() == 0
    assert history.table_summary(df).first()["events"] == 0
    assert alerts.sustained_extreme(df).count() == 0 and alerts.silent_gaps(df).count() == 0


def test_hour_range(spark):
    pair = cal.ordered_hours(F.col("a"), F.col("b"))
    df = spark.createDataFrame([(20, 5), (-3, 40)], "a int, b int").select(*pair)
    assert rows(df) == [(5, 20), (0, 23)]


def test_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(at("2024-12-30T12:00:00"),)], "ts timestamp_ntz")
    r = cal.with_calendar(df, "ts", None).first()
    assert (r["iso_week"], r["day_of_week"], r["month"]) == (1, 0, 12)


def test_heat_colour(spark):
    df = spark.createDataFrame([(None,), (2.0,), (-9.0,), (20.0,), (99.0,), (8.0,)], "t double")
    got = [r[0] for r in df.select(bands.heat_colour(F.col("t"))).collect()]
    assert got[0] is None and got[1] == got[2] == "rgb(30,58,95)" and got[3] == got[4] == "rgb(239,61,48)"
    assert got[5] == "rgb(32,158,116)"


def test_counter_reset(spark):
    data = [(i, "a", at(f"2024-01-0{d}T00:00:0{s}"), v) for i, (d, s, v) in enumerate([(1, 0, 10), (1, 5, 12), (3, 0, 1)])]
    df = spark.createDataFrame(data, "event_id long, station string, ts timestamp_ntz, v long")
    out = counters.increases(counters.samples(df, "v")).orderBy("sec").collect()
    assert [r["increase"] for r in out] == [0, 2, 1]


def test_counter_counts_every_sample_of_a_second(spark):
    data = [(i, "a", at(f"2024-01-01T00:00:{s}"), v) for i, (s, v) in enumerate(
        [("00.1", 10), ("01.1", 12), ("01.2", 1), ("01.2", 13), ("09", 2), ("09.5", None)])]
    df = spark.createDataFrame(data, "event_id long, station string, ts timestamp_ntz, v long")
    out = counters.increases(counters.samples(df, "v")).orderBy("sec").collect()
    assert [(r["v"], r["increase"]) for r in out] == [(10, 0), (13, 15), (2, 2)]


def test_station_of_nulls_keeps_its_hours(spark):
    data = [("a", at("2024-01-01T00:00:00"), None), ("a", at("2024-01-01T02:00:00"), None), ("b", at("2024-01-01T00:00:00"), 1.0)]
    df = spark.createDataFrame(data, "station string, hr timestamp_ntz, temp double")
    got = rows(hourly.interpolate_hours(df).select("station", F.hour("hr").alias("h"), "temp", "filled"), "station", "h")
    assert got == [("a", 0, None, True), ("a", 1, None, True), ("a", 2, None, True), ("b", 0, 1.0, False)]


def test_newest_rows_beyond_the_broadcast_limit(spark):
    data = [(i, f"s{i % 3}", at(f"2024-01-0{1 + i % 7}T00:00:00")) for i in range(30)]
    df = spark.createDataFrame(data, "event_id long, station string, ts timestamp_ntz")
    anchors = df.groupBy("station").agg(F.max("ts").alias("m"))
    assert rows(keyed.join_per_key(df, anchors, ["station"], 2), "event_id") == rows(keyed.join_per_key(df, anchors, ["station"]), "event_id")
    assert history.trailing_period(df.limit(0), "week", "station").count() == 0


def test_counter_rate_looks_back_over_midnight(spark):
    data = [(1, "a", at("2024-01-01T23:59:30"), 5), (2, "a", at("2024-01-01T23:59:59"), 7), (3, "a", at("2024-01-02T00:00:20"), 10)]
    df = spark.createDataFrame(data, "event_id long, station string, ts timestamp_ntz, v long")
    out = counters.counter_rate(df, "v", 60).orderBy("sec").collect()
    assert [r["window_increase"] for r in out] == [0, 2, 5]
    assert [r["rate_per_min"] for r in out] == [0.0, 2.0, 5.0]


def brute_runs(data, hold):
    """Runs of extreme instants per station, by walking the readings in order."""
    out, by = [], {}
    for _, station, ts, temp in data:
        by.setdefault(station, {}).setdefault(ts, []).append(temp > 30 or temp < -10)
    for station, instants in by.items():
        run = []
        for ts in sorted(instants) + [None]:
            if ts is not None and all(instants[ts]):
                run.append(ts)
                continue
            if run and (run[-1] - run[0]).total_seconds() >= hold:
                out.append((station, run[0], run[-1]))
            run = []
    return sorted(out)


def test_sustained_broken_run(spark):
    data = [(i, "a", at(f"2024-01-01T00:0{m}:00"), t) for i, (m, t) in enumerate([(0, 31.0), (1, 31.0), (2, 29.0), (4, 31.0)])]
    assert alerts.sustained_extreme(readings_df(spark, data)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sustained_equals_walk(spark, seed):
    import random

    rng = random.Random(seed)
    data, t = [], {"a": at("2024-01-01T23:30:00"), "b": at("2024-01-01T00:00:00")}
    hot = {"a": False, "b": True}
    for i in range(900):
        s = rng.choice("ab")
        t[s] += dt.timedelta(seconds=rng.choice([0, 1, 20, 61, 140, 400]))
        hot[s] = hot[s] if rng.random() < 0.85 else not hot[s]
        data.append((i, s, t[s], rng.choice([31.5, -12.0]) if hot[s] else 15.0))
    got = rows(alerts.sustained_extreme(readings_df(spark, data)).select("station", "started", "ended"), "station", "started")
    assert got == brute_runs(data, 300) and got


def test_silence_limit_is_strict(spark):
    data = [(i, "a", at(x), 1.0) for i, x in enumerate(
        ["2024-01-01T00:00:00", "2024-01-01T00:01:00", "2024-01-01T00:02:00.000001", "2024-01-01T00:02:30", "2024-01-02T00:00:00"])]
    got = alerts.silent_gaps(readings_df(spark, data)).orderBy("silent_from").collect()
    assert [r["gap_s"] for r in got] == [60.000001, 86250.0]


@pytest.mark.parametrize("lag,pct,alert", [(40, 80.0, False), (41, 80.4, True), (0, 0.0, False)])
def test_backpressure(spark, lag, pct, alert):
    df = spark.createDataFrame([("t", 0, 100 + lag, 100), ("t", 1, 5, 5)], "topic string, partition int, end_offset long, current_offset long")
    r = alerts.backpressure(df).first()
    assert (r["lag"], r["backpressure_pct"], r["alert"]) == (lag, pct, alert)


def test_threshold_alerts_are_strict(spark):
    df = spark.createDataFrame([(1, 5.0, 5.0, 0.5), (2, 5.001, 5.01, 0.49)],
                               "batch_no long, latency_s double, error_pct double, throughput_per_min double")
    assert rows(alerts.threshold_alerts(df).select("batch_no", "alert", "severity"), "alert") == [
        (2, "errors", "error"), (2, "latency", "warning"), (2, "throughput", "warning")]


def test_running_metrics_first_batches(spark):
    df = spark.createDataFrame([(1, 10, 0, 2140), (2, 10, 1, 5500)], "batch_no long, rows long, errors long, latency_ms long")
    got = [r.asDict() for r in pipeline_metrics.running_metrics(df).orderBy("batch_no").collect()]
    assert [g["throughput_per_min"] for g in got] == [10.0, 20.0]
    assert [g["mean_latency_s"] for g in got] == [2.14, 3.82] and got[1]["error_pct"] == 5.0
    assert pipeline_metrics.operating_summary(df.limit(0)).count() == 0


def test_chunked_sequences_match_plain_ones(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("seq"), (F.col("id") % 7).alias("x"))
    total = {r["seq"]: r["t"] for r in ordered.running_totals(df, "seq", {"t": "x"}, width=50).collect()}
    numbered = ordered.sequence_number(df, "seq", "n", width=50)
    tail = {r["seq"]: r["s"] for r in ordered.trailing_rows(numbered, "n", 20, {"s": lambda w: F.sum("x").over(w)}, width=64).collect()}
    xs = [i % 7 for i in range(1000)]
    for i in range(1000):
        assert total[i * i] == sum(xs[: i + 1]) and tail[i * i] == sum(xs[max(0, i - 19): i + 1])


def test_interpolation_ends(spark):
    hours = [("00", None), ("02", 10.0), ("05", 40.0), ("07", None)]
    df = spark.createDataFrame([("a", at(f"2024-01-01T{h}:00:00"), t) for h, t in hours], "station string, hr timestamp_ntz, temp double")
    got = [r["temp"] for r in hourly.interpolate_hours(df).orderBy("hr").collect()]
    assert got == [None, None, 10.0, 20.0, 30.0, 40.0, 40.0, 40.0]


def test_top_k_with_a_hot_station(spark):
    df = spark.range(20000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("station"),
        F.timestamp_seconds(F.col("id") / 10).cast("timestamp_ntz").alias("ts"),
    ).repartition(16)
    got = latest.top_k(df, ["station"], [F.col("ts").desc(), F.col("event_id").desc()], 5)
    want = {("hot", i) for i in range(19995, 20000)} | {("cold", i) for i in range(19500, 20000, 100)}
    assert {(r["station"], r["event_id"]) for r in got.collect()} == want


def test_describe_small(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5), (4.0, 5), (8.0, 5)], "a double, b int")
    got = {r["column_name"]: r for r in describe.describe(df, ["a", "b"]).collect()}
    assert (got["a"]["rows"], got["a"]["q25"], got["a"]["q50"], got["a"]["q75"]) == (4, 1.75, 3.0, 5.0)
    assert got["b"]["rows"] == 3 and got["b"]["std"] == 0.0


def test_sums_over_very_many_rows_and_numbers_that_are_none(spark):
    from climaflow.functions.fixedpoint import hundredths, mean_of_hundredths

    rows = spark.createDataFrame([(101_325 * 100 * 10**10, 10**12, float("nan")), (7, 2, float("inf")), (-7, 2, 20.25)], "s bigint, n bigint, x double")
    got = rows.select(mean_of_hundredths("s", "n", 3).alias("m"), hundredths("x").alias("h")).collect()
    assert [(r.m, r.h) for r in got] == [(1013.25, None), (0.035, None), (-0.035, 2025)]
