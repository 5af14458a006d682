"""Sums and means of readings with any decimals; quantiles by selection against sorted columns."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from climaflow.functions.fixedpoint import exact_mean_of, exact_sum, mean_of, usable
from climaflow.operators import describe, history, hourly
from climaflow.operators.windows import WindowSpec, windowed_aggregate
from climaflow.sources.events import readings

ROW = "station string, ts timestamp_ntz, temp double, humidity int, wind double, feels_like double, pressure double, hour_of_day int"


def total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    return df.agg(exact_sum("x").alias("s"), F.count(usable("x")).alias("n")).select(
        "s", "n", mean_of("s", "n").alias("m"), mean_of("s", "n", 3).alias("m3"), exact_mean_of("s", "n").alias("e")).first()


def test_third_decimals_count(spark):
    got = total(spark, [20.004, 20.004, 20.007])
    assert (got.m, got.m3, got.e) == (20.01, 20.005, 20.005)


def test_totals_are_those_of_the_written_decimals(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(-50, 50), rng.randrange(0, 10)) for _ in range(3000)] + [0.1, 0.2, 0.3, 1e-7, -1e-12, 123456.789012]
    got = total(spark, values)
    want = sum(Decimal(repr(v)) for v in values)
    assert got.s == want and got.n == len(values)
    assert got.m == float((want / got.n).quantize(Decimal("0.01"), "ROUND_HALF_UP"))


def test_order_and_mixture_do_not_matter(spark):
    values = [0.1, 0.25, 0.125, 1e-9, -7.005, 1e6 + 0.001]
    assert len({total(spark, random.Random(k).sample(values, len(values))).s for k in range(4)}) == 1


def test_no_readings(spark):
    got = total(spark, [float("nan"), float("inf"), -float("inf"), None, 1e300])
    assert (got.s, got.n, got.m, got.e) == (0, 0, None, None)
    one = total(spark, [float("nan"), -0.005, None])
    assert (one.n, one.m) == (1, -0.01)


def test_operators_keep_third_decimals(spark):
    import datetime as dt

    at = dt.datetime(2024, 1, 1, 0, 1)
    df = spark.createDataFrame([("a", at, t, 50, 1.001, 2.5, 1000.125, 0) for t in (20.004, 20.004, 20.007)] + [("a", at, float("nan"), 50, None, None, None, 0)], ROW)
    w = windowed_aggregate(df, WindowSpec(measures=("avg_temp", "max_temp", "min_temp", "mean_temp", "avg_wind", "events"))).first()
    assert (w.avg_temp, w.max_temp, w.min_temp, w.mean_temp, w.avg_wind, w.events) == (20.01, 20.007, 20.004, 20.005, 1.0, 4)
    assert history.rounded_means(df).first()["avg_temp_3dp"] == 20.005
    assert hourly.hourly_means(df).first()["temp"] == 20.005
    assert history.history(df, "year").first()["avg_pressure"] == 1000.13
    assert {r["avg_temp"] for r in history.heatmaps(df).where("hour = 0").collect()} == {20.01}


def test_adapter_keeps_decimals(spark):
    df = spark.createDataFrame([(1, "a", 6.55, '{"k": 10}', 3), (2, "a", 6.554321, '{"k": 10}', 3), (3, "a", None, None, 3)],
                               "event_id long, event_type string, value double, props string, user_id long").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    got = [(r["temp"], r["feels_like"]) for r in readings(df).orderBy("event_id").collect()]
    assert got == [(-13.45, -13.85), (-13.445679, -13.845679), (None, None)]


def columns():
    rng = np.random.default_rng(8)
    yield "normal", rng.normal(size=5000)
    yield "ties", rng.integers(0, 3, 5000) / 7
    yield "one_value", np.full(2000, 3.25)
    yield "two_values", np.where(rng.random(5000) < 0.5, -1.0, 1e9)
    yield "wide", np.concatenate([10.0 ** rng.uniform(-300, 15, 3000), -(10.0 ** rng.uniform(-300, 15, 3000))])
    yield "lumps", np.concatenate([np.full(3000, 0.125), rng.normal(size=1500), np.full(800, 0.25)])
    yield "few", np.array([1.0, 2.0, 4.0])
    yield "single", np.array([7.5])


@pytest.mark.parametrize("name,values", list(columns()), ids=lambda v: v if isinstance(v, str) else "")
def test_quantiles_equal_a_sorted_column(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(5)
    shares = {"a": 0.0, "b": 0.03, "c": 0.25, "d": 0.5, "e": 0.75, "f": 0.999, "g": 1.0}
    for keep in (10, 4000):
        got = describe.exact_quantiles(df, ["x"], shares, keep)["x"]
        ordered = np.sort(values)
        for q, p in shares.items():
            at = (len(ordered) - 1) * p
            low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
            assert got[q] == low + (high - low) * (at - math.floor(at)), (name, keep, q)


def test_selection_without_a_sketch_begins_with_one(spark):
    values = [float((7919 * k) % 10007) for k in range(10007)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = describe.select_ranks(df, {"x": [0, 17, 5003, 10006]}, {"x": 10007}, keep=20)
    assert got == {("x", r): float(r) for r in (0, 17, 5003, 10006)}


def test_describe_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert describe.describe(df, ["a", "b"]).collect() == []
    df = spark.createDataFrame([(None, 2)], "a double, b int")
    got = describe.describe(df, ["a", "b"]).collect()
    assert [(r["column_name"], r["rows"], r["std"], r["q50"]) for r in got] == [("b", 1, None, 2.0)]
