"""Whitening against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from climaflow.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, x int, n string, deviation int"


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + k, v, 1, "k", 2, "n", 3) for k, v in enumerate(vectors)], SCHEMA).repartition(4)


def usable(vectors):
    return [k for k, v in enumerate(vectors) if v and all(c is not None and math.isfinite(c) for c in v)]


def plain(vectors, components=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    q = n * x.astype(object) - s.astype(object)
    c = (q / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, x.shape[1])
    return n, (q**2).sum(1), c @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(got, vectors, at, components=32):
    n, deviation, whitened, explained = plain([vectors[k] for k in at], components)
    got = {r["key"]: r for r in got}
    assert sorted(got) == at
    signs = np.sign(np.array([got[k]["whitened"] for k in at]) * whitened).sum(0)
    for row, k in enumerate(at):
        r = got[k]
        assert (r["n"], int(r["deviation"])) == (n, deviation[row])
        assert np.allclose(r["whitened"], whitened[row] * np.sign(signs), rtol=1e-8, atol=1e-9)
        assert np.allclose(r["explained"], explained, rtol=1e-9)
        assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("n,d,block_rows,slab", [(500, 8, 1000, None), (333, 40, 10, 5), (257, 33, 7, 100), (50, 1, 3, 2)])
def test_equals_numpy_over_blocks_and_slabs(spark, n, d, block_rows, slab):
    rng = np.random.default_rng(n)
    vectors = (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 3).astype(np.float32).tolist()
    got = whitening.whiten(table(spark, vectors), block_bytes=block_rows * 8 * d, slab_blocks=slab).collect()
    check(got, vectors, list(range(n)))


def test_vectors_that_are_dropped(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(60, 4)).astype(np.float32).tolist()
    vectors[3], vectors[10], vectors[20][1], vectors[30][0], vectors[40][3], vectors[41][2] = None, [], None, float("nan"), float("inf"), -float("inf")
    at = usable(vectors)
    check(whitening.whiten(table(spark, vectors)).collect(), vectors, at)
    other = [*vectors, [1.0, 2.0], [1.0, 2.0, 3.0, 4.0, 5.0]]
    check(whitening.whiten(table(spark, other)).collect(), vectors, at)


def test_null_and_repeated_keys_and_equal_rows(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(40, 3)).astype(np.float32).tolist()
    df = table(spark, vectors + vectors).withColumn("vec_id", F.when(F.col("vec_id") % 40 > 1, F.col("vec_id") % 40))
    got = whitening.whiten(df).collect()
    assert len(got) == 80 and sum(r["key"] is None for r in got) == 4
    by = {}
    for r in got:
        if r["key"] is not None:
            by.setdefault(r["key"], []).append((r["deviation"], tuple(r["whitened"])))
    assert all(len(v) == 2 and v[0][0] == v[1][0] and np.allclose(v[0][1], v[1][1], atol=1e-12) for v in by.values())


def test_dimensions_without_variance(spark):
    rng = np.random.default_rng(3)
    vectors = [[*map(float, v), 7.0, float(v[0])] for v in rng.normal(size=(30, 2)).astype(np.float32)]
    got = whitening.whiten(table(spark, vectors)).collect()
    assert all(r["whitened"][2:] == [0.0, 0.0] and r["identity_error"] < 1e-6 for r in got)
    one = whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).collect()
    assert [(r["whitened"], int(r["deviation"]), r["identity_error"], r["explained"]) for r in one] == [([0.0, 0.0], 0, None, [0.0, 0.0])] * 5


def test_large_entries_stay_exact(spark):
    vectors = [[float(2**40 + k * 2**20), 1.0 + k % 3] for k in range(20)]
    got = whitening.whiten(table(spark, vectors)).collect()
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(object) + 1_000_000
    x = np.vectorize(int, otypes=[object])(x)
    want = ((20 * x - x.sum(0)) ** 2).sum(1)
    assert {r["key"]: int(r["deviation"]) for r in got} == dict(enumerate(want))
    too_large = whitening.whiten(table(spark, [[3e38, 1.0], [1.0, 2.0], [2.0, 0.5]])).collect()
    assert sorted(r["key"] for r in too_large) == [1, 2]


def test_empty_tables(spark):
    for df in (table(spark, [[1.0]]).where("false"), table(spark, [None, []])):
        assert whitening.whiten(df).collect() == []


def test_query_has_the_columns_of_its_contract(spark, small):
    got = whitening.op12_embedding_whitening(spark, small)
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                          ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: r["embedding"] for r in rows}
    n, deviation, whitened, explained = plain(list(vectors.values()))
    found = {}
    for r in got.collect():
        found[r["vec_id"], r["component"]] = r
    assert len(found) == n * min(32, len(rows[0]["embedding"]))
    for row, v in enumerate(vectors):
        for c in range(1, 33):
            r = found[v, c]
            assert r["deviation"] == deviation[row] and abs(abs(r["whitened"]) - abs(whitened[row, c - 1])) < 1e-8
            assert abs(r["explained"] / explained[c - 1] - 1) < 1e-9 and r["identity_error"] < 1e-4
