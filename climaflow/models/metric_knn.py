"""Exact k-nearest-neighbour regression over many real-valued features, by pivots and triangle bounds.

Training rows belong to the nearest of a bounded number of pivots, which are training rows themselves. A query is first
compared with the rows of its own pivot, which bounds the distance of its k-th neighbour. Another pivot's rows are looked
at only if some of them can be within that bound: a row of pivot p is at least d(query, p) - radius away, at least
nearest - d(query, p), and, as it is nearer to p than to the query's own pivot o, at least (d(query, p) - d(query, o)) / 2.
Inside a pivot, a row is compared only if its distance to the pivot differs from the query's by no more than the bound.
Rows and queries meet by equality joins on the pivot, and nothing is rounded to cells.

The pivots are the only rows that reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .knn import DISTANCE_DIGITS, K, _vote

PIVOTS = 256
# Bounds are widened by this much, so that rounding never loses a neighbour.
SLACK = 1e-6


def _scaled(features: list[str], scale: dict[str, float]) -> Column:
    return F.array(*[F.col(f).cast("double") / F.lit(scale[f]) for f in features])


def _squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v)


def deviations(train: DataFrame, features: list[str]) -> dict[str, float]:
    """Population deviation of each feature, 1 where it is constant."""
    row = train.agg(*[F.stddev_pop(F.col(f).cast("double")).alias(f) for f in features]).first()
    return {f: row[f] if row[f] and row[f] > 1e-9 else 1.0 for f in features}


def _to_pivots(points: list[list[float]]) -> tuple[Column, Column]:
    """Distances to all pivots of the column ``x``, and the nearest one as (distance, pivot)."""
    literal = F.array(*[F.array(*[F.lit(float(v)) for v in p]) for p in points])
    apart = F.transform(literal, lambda p: F.sqrt(_squared(F.col("x"), p)))
    return apart, F.array_min(F.transform(F.col("apart"), lambda d, i: F.struct(d.alias("d"), i.alias("pivot"))))


def predict(train: DataFrame, queries: DataFrame, features: list[str], label: str, k: int = K, pivots: int = PIVOTS,
            scale: dict[str, float] | None = None) -> DataFrame:
    """``queries`` with ``knn``, the mean ``label`` of the k nearest rows of ``train`` by standardised features.

    Rows at the k-th distance share the places that are left. Rows with a null feature or label are no neighbours, and
    queries with a null feature get a null.
    """
    complete = F.lit(True)
    for f in features:
        complete &= F.col(f).isNotNull()
    known = train.where(complete & F.col(label).isNotNull())
    scale = scale or deviations(known, features)
    t = known.select(_scaled(features, scale).alias("x"), (F.col(label) * 100.0).alias("y"))
    q = cut(queries.withColumn("_query", F.monotonically_increasing_id()))
    n = t.count()
    if not n:
        return q.drop("_query").withColumn("knn", F.lit(None).cast("double"))
    chosen = t.orderBy(F.xxhash64("x"), "x").limit(min(pivots, math.isqrt(n) + 1)).select("x").distinct()
    points = [r["x"] for r in chosen.orderBy("x").collect()]
    apart, nearest = _to_pivots(points)
    placed = t.withColumn("apart", apart).withColumn("near", nearest)
    t = cut(placed.select("x", "y", F.col("near.pivot").alias("pivot"), F.col("near.d").alias("to_pivot")))
    seen = q.where(complete).select("_query", _scaled(features, scale).alias("x")).withColumn("apart", apart).withColumn("near", nearest)
    seen = cut(seen.select("_query", "x", "apart", F.col("near.pivot").alias("own"), F.col("near.d").alias("to_own")))

    # At most one row per pivot.
    cells = {r["pivot"]: r for r in t.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("n"), F.min("to_pivot").alias("low"), F.max("to_pivot").alias("high")).collect()}
    bounds = F.array(*[F.struct(
        F.lit(int(cells[p]["n"]) if p in cells else 0).alias("n"), F.lit(float(cells[p]["low"]) if p in cells else 0.0).alias("low"),
        F.lit(float(cells[p]["high"]) if p in cells else 0.0).alias("high")) for p in range(len(points))])
    # Without looking at rows: so many lie within d(query, p) + radius of p.
    reaches = F.array_sort(F.transform(F.arrays_zip(F.col("apart"), bounds.alias("b")), lambda z: F.struct(
        (z["apart"] + z["b"]["high"]).alias("reach"), z["b"]["n"].alias("n"))))
    first = F.aggregate(reaches, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("reach")), lambda s, r: F.struct(
        (s["n"] + r["n"]).alias("n"), F.when(s["n"] >= k, s["reach"]).otherwise(r["reach"]).alias("reach")))["reach"]
    seen = seen.withColumn("reach", first + SLACK)

    def compared(rows: DataFrame) -> DataFrame:
        """Distances of queries (with ``pivot`` and ``to_query``) to the rows of a pivot that can be within reach."""
        met = rows.join(t.withColumnsRenamed({"x": "t"}), "pivot").where(F.abs(F.col("to_query") - F.col("to_pivot")) <= F.col("reach"))
        return met.select("_query", F.round(_squared(F.col("x"), F.col("t")), DISTANCE_DIGITS).alias("d"), F.lit(1).cast("long").alias("n"), F.col("y").alias("s"))

    own = cut(compared(seen.select("_query", "x", "reach", F.col("own").alias("pivot"), F.col("to_own").alias("to_query"))))
    by_distance = own.groupBy("_query", "d").agg(F.sum("n").alias("n"))
    from pyspark.sql import Window as W

    upto = F.sum("n").over(W.partitionBy("_query").orderBy("d"))
    kth = by_distance.withColumn("upto", upto).where(F.col("upto") >= k).groupBy("_query").agg(F.sqrt(F.min("d")).alias("kth"))
    seen = seen.join(kth, "_query", "left").withColumn("reach", F.least("reach", F.coalesce(F.col("kth") + SLACK, F.col("reach"))))
    others = F.filter(F.transform(F.arrays_zip(F.col("apart"), bounds.alias("b")), lambda z, i: F.struct(
        i.alias("pivot"), z["apart"].alias("to_query"),
        ((z["b"]["n"] > 0) & (i != F.col("own")) & (F.greatest(
            z["apart"] - z["b"]["high"], z["b"]["low"] - z["apart"], (z["apart"] - F.col("to_own")) / 2) <= F.col("reach"))).alias("open"))),
        lambda z: z["open"])
    more = seen.select("_query", "x", "reach", F.explode(others).alias("o")).select("_query", "x", "reach", "o.pivot", "o.to_query")
    found = own.unionByName(compared(more))
    votes = _vote(found, ["_query"], k).select("_query", "knn")
    return q.join(votes, "_query", "left").drop("_query")
