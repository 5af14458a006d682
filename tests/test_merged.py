"""Tables of current rows over many batches, their versions, and sinks that fail."""

import pytest
from pyspark.sql import functions as F

from climaflow.sinks import fanout
from climaflow.sinks.manifest import Manifest
from climaflow.sinks.merged import MergedTable


def batch(spark, rows):
    return spark.createDataFrame(rows, "k int, v int").coalesce(1)


def files_below(path):
    return sorted(p.name for p in path.glob("rows/*"))


def test_folders_stay_few_and_the_newest_row_stays(spark, tmp_path):
    table, want = MergedTable(str(tmp_path), ["k"], fan=3), {}
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    most = 0
    try:
        for b in range(28):
            rows = [(b % 7, b), (b % 11, 1000 + b) if b % 7 != b % 11 else (100, b), (None, b)]
            table.put(batch(spark, rows), b)
            want.update(dict(rows))
            most = max(most, len(files_below(tmp_path)))
            if b in (0, 1, 8, 26, 27):
                assert {r["k"]: r["v"] for r in table.read(spark).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    # Two folders on each of four levels, and those that wait to be deleted.
    assert len(table.folders(spark)) <= 8 and most <= 8 + 3 * 4
    assert len(Manifest(str(tmp_path)).versions(spark)) <= 3


def test_repeated_and_broken_batches(spark, tmp_path):
    table = MergedTable(str(tmp_path), ["k"], fan=2)
    assert table.through(spark) == -1
    table.put(batch(spark, [(1, 1)]), 0)
    # Written, but ended before its commit.
    batch(spark, [(1, 99), (5, 5)]).withColumn("_batch", F.lit(1).cast("bigint")).write.parquet(f"{tmp_path}/rows/batch-1")
    assert [tuple(r) for r in table.read(spark).collect()] == [(1, 1)]
    table.put(batch(spark, [(2, 2)]), 1)
    table.put(batch(spark, [(2, 77)]), 1)
    table.put(batch(spark, [(1, 78)]), 0)
    assert sorted(tuple(r) for r in table.read(spark).collect()) == [(1, 1), (2, 2)]
    assert table.through(spark) == 1


def test_largest_column_decides_within_a_batch(spark, tmp_path):
    table = MergedTable(str(tmp_path), ["k"], ("v",))
    table.put(batch(spark, [(1, 5), (1, 9), (1, 7), (1, None)]), 0)
    assert [tuple(r) for r in table.read(spark).collect()] == [(1, 9)]
    table.put(batch(spark, [(1, 2)]), 1)
    assert [tuple(r) for r in table.read(spark).collect()] == [(1, 2)]


def test_empty_batches(spark, tmp_path):
    table = MergedTable(str(tmp_path), ["k"], fan=2)
    for b in range(5):
        table.put(batch(spark, []), b)
    assert table.read(spark).collect() == [] and table.through(spark) == 4


def test_a_reader_of_an_older_version_still_finds_its_folders(spark, tmp_path):
    table = MergedTable(str(tmp_path), ["k"], fan=2)
    table.put(batch(spark, [(1, 1)]), 0)
    begun = table.read(spark)
    table.put(batch(spark, [(1, 2)]), 1)  # merges the folder that ``begun`` reads
    assert [tuple(r) for r in begun.collect()] == [(1, 1)]


def test_second_writer_of_a_version_fails(spark, tmp_path):
    manifest = Manifest(str(tmp_path))
    assert manifest.read(spark) == (0, None)
    manifest.commit(spark, 1, {"a": "ñ"})
    with pytest.raises(RuntimeError):
        manifest.commit(spark, 1, {"a": 2})
    assert manifest.read(spark) == (1, {"a": "ñ"})


class Flaky:
    def __init__(self, write, fails):
        self.write, self.fails = write, fails

    def __call__(self, df, name):
        if self.fails:
            self.fails -= 1
            # Leaves something behind, as a real failure may.
            df.limit(1).write.mode("overwrite").parquet(f"{self.write}/{name}")
            raise OSError("no space")
        df.write.mode("overwrite").parquet(f"{self.write}/{name}")


def held(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(str(path)).select("k", "v").collect()), key=str)


def test_failed_writes_are_driven_again(spark, tmp_path):
    flaky, steady = Flaky(f"{tmp_path}/flaky", 2), Flaky(f"{tmp_path}/steady", 0)
    fan = fanout.FanOut({"flaky": flaky, "steady": steady}, f"{tmp_path}/outcomes", f"{tmp_path}/spare")
    fan(batch(spark, [(1, 1), (2, 2), (None, None)]), 0)
    lacking = fanout.failed_writes(fan.outcomes(spark)).collect()
    assert [(r["batch"], r["sink"], r["attempts"]) for r in lacking] == [(0, "flaky", 1)] and "no space" in lacking[0]["error"]
    fan(batch(spark, [(3, 3)]), 1)  # drives batch 0 again, which fails once more
    assert {(r["batch"], r["sink"]): (r["ok"], r["attempts"]) for r in fan.outcomes(spark).collect()} == {
        (0, "flaky"): (False, 2), (0, "steady"): (True, 1), (1, "flaky"): (True, 1), (1, "steady"): (True, 1)}
    assert [r["ok"] for r in fan.redo(spark).collect()] == [True]
    assert fanout.failed_writes(fan.outcomes(spark)).count() == 0
    assert held(spark, tmp_path / "flaky") == held(spark, tmp_path / "steady")
    assert list((tmp_path / "spare").glob("batch_id=*")) == []
    assert fan.redo(spark).collect() == []


def test_a_batch_that_no_sink_takes_is_not_committed(spark, tmp_path):
    one = Flaky(f"{tmp_path}/one", 1)
    fan = fanout.FanOut({"one": one}, f"{tmp_path}/outcomes", f"{tmp_path}/spare")
    with pytest.raises(RuntimeError, match="no sink took batch 0"):
        fan(batch(spark, [(1, 1)]), 0)
    fan(batch(spark, [(1, 1)]), 0)
    assert held(spark, tmp_path / "one") == [(1, 1)] and fan.outcomes(spark).first()["ok"]


def test_a_replayed_batch_replaces_its_rows(spark, tmp_path):
    steady = Flaky(f"{tmp_path}/steady", 0)
    fan = fanout.FanOut({"steady": steady}, f"{tmp_path}/outcomes")
    for _ in range(2):
        fan(batch(spark, [(1, 1)]), 0)
    assert held(spark, tmp_path / "steady") == [(1, 1)] and fan.outcomes(spark).count() == 1
    with pytest.raises(ValueError):
        fan.redo(spark)
