"""Physical plans: no cross products, no unpartitioned windows, no Python rows, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from climaflow.operators import history, latest
from climaflow.plans import batch
from climaflow.sinks import tables
from climaflow.sources.events import events, full_readings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(batch.QUERIES))
def test_batch_plan(spark, small, name):
    text = plan(batch.QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "EvalPython" not in text and "InPandas" not in text
    # one task may see one row per task below it; whole-table windows only over chunk totals
    lines = text.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[], functions=[partial" in below or "_chunk" in below


def test_scan_reads_only_what_it_needs(spark, small):
    text = plan(batch.QUERIES["not_null_scan"](spark, small))
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>", text)
    assert "IsNotNull(ts)" in text


def test_period_filter_reaches_the_scan(spark, small):
    text = plan(batch.QUERIES["history_week"](spark, small))
    assert re.search(r"DataFilters: \[isnotnull\(ts#\d+\), \(ts#\d+ >= Subquery", text)


@pytest.mark.parametrize("name", ["history_week_per_station", "last_60_series", "last_40_series", "event_log_10", "latest_per_station"])
def test_raw_rows_are_not_shuffled_by_station(spark, small, name):
    """As on a large table, where no side is small enough to broadcast unasked."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan(batch.QUERIES[name](spark, small))
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_last_k_is_limited_before_the_shuffle(spark, small):
    text = plan(batch.QUERIES["last_60_series"](spark, small))
    assert text.count("WindowGroupLimit") == 4


def test_date_partitions_are_pruned(spark, small, tmp_path):
    """Also where one station has stopped long ago: only its own last day is added to the newest ones."""
    rows = full_readings(events(spark, small)).where("ts is not null")
    old = rows.where("event_id = 1").withColumns({
        "station": F.lit("gone"), "ts": F.lit("2001-02-03 04:05:06").cast("timestamp_ntz")})
    tables.append_table(rows.unionByName(old), f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert table.schema["date"].dataType.simpleString() == "date"

    newest = latest.latest_per_station(table, day="date")
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(newest))
    assert any("2001-02-03" in f or "11356" in f for f in filters), filters
    key = lambda df: sorted(map(str, df.collect()))
    assert key(newest) == key(latest.latest_per_station(table.drop("date")))
    needed = latest.recent_days(table, ["station"], 1, "date")
    assert needed.select("date").distinct().count() <= table.select("station").distinct().count()

    week = history.history(table, "week", day="date")
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= ", plan(week))
    assert key(week) == key(history.history(table.drop("date"), "week"))


def test_newest_rows_of_an_empty_table(spark, small):
    none = full_readings(events(spark, small)).limit(0)
    assert latest.last_series(none).count() == 0 and latest.event_log(none).count() == 0
