"""Connected components of a link table by alternating star contraction.

Each round lets every node's larger neighbours point to its smallest one, then its smaller neighbours and itself as
well. Minima are grouped sums that combine map-side, and the joins back are plain equality joins, which adaptive
execution splits where one node has a third of all links. Rounds grow with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import delete, written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    ways = _both_ways(links)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # Links run from the larger to the smaller end.
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def roots(links: DataFrame) -> DataFrame:
    """``node`` and its component's smallest node ``root``, for every node of the links (a, b) but the roots."""
    now, path = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        before = path
        now, path = written(_small_star(_large_star(now)))
        delete(links.sparkSession, before)
        # Stars stay as they are: the sums of a hash over the links show that nothing has moved.
        fresh = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if fresh == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = fresh
