"""Exact k-nearest-neighbour regression over feature cells, by equi-joins only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut

K = 5
DISTANCE_DIGITS = 9


@dataclass(frozen=True)
class Profile:
    """Scale and occurring values of each feature of the training cells."""

    scale: dict[str, float]
    values: dict[str, list[float]]


def profile(train: DataFrame, features: list[str]) -> Profile:
    """Population deviation over the rows behind the cells (1 where constant) and value lists.

    The lists are short: features are whole numbers of a small range (hours, weekdays, months,
    weeks, degrees).
    """
    n = F.col("n").cast("double")
    sums = [F.sum(n).alias("n")]
    for f in features:
        x = F.col(f).cast("double")
        sums += [F.sum(n * x).alias(f"{f}_1"), F.sum(n * x * x).alias(f"{f}_2"), F.collect_set(x).alias(f"{f}_v")]
    row = train.agg(*sums).first()
    scale = {}
    for f in features:
        mean = row[f"{f}_1"] / row["n"]
        variance = row[f"{f}_2"] / row["n"] - mean * mean
        scale[f] = math.sqrt(variance) if variance > 1e-12 else 1.0
    return Profile(scale, {f: sorted(row[f"{f}_v"]) for f in features})


def _distance(features: list[str], scale: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for f in features:
        gap = (F.col(f"q_{f}") - F.col(f"t_{f}")) / F.lit(scale[f])
        total = total + gap * gap
    return F.round(total, DISTANCE_DIGITS)


def _vote(near: DataFrame, features: list[str], k: int) -> DataFrame:
    """Mean of the k nearest rows and how many rows were found (at most k). Cells at the k-th
    distance share the places that are left."""
    by_distance = near.groupBy(*features, "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    ahead = W.partitionBy(*features).orderBy("d").rowsBetween(W.unboundedPreceding, -1)
    placed = by_distance.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    used = placed.where(F.col("before") < k).withColumn("take", F.least(F.col("n"), k - F.col("before")))
    # Only the last distance can be taken in part. Whole ones add up as whole numbers, so the result
    # does not depend on the order of the sum.
    whole = F.coalesce(F.sum(F.when(F.col("take") == F.col("n"), F.col("s"))), F.lit(0)).cast("double")
    part = F.coalesce(F.sum(F.when(F.col("take") < F.col("n"), F.col("take") * F.col("s") / F.col("n"))), F.lit(0.0))
    return used.groupBy(*features).agg(
        F.sum("take").alias("found"), ((whole + part) / F.sum("take") / 100.0).alias("knn")
    )


def _blocks(prefix: str, features: list[str], scale: dict[str, float]) -> dict[str, Column]:
    return {f"b_{f}": F.floor(F.col(f"{prefix}{f}") / F.lit(scale[f]) / F.col("size")) for f in features}


def _within(train: DataFrame, queries: DataFrame, features, scale, unit: float, levels: list[int]) -> DataFrame:
    """Query and training cells no further apart than the query's radius, ``unit * 2^level``.

    Each level has its own grid, with blocks a little wider than the radius: all such cells lie in
    the query's block or one next to it, so an equality join on level and block finds them.
    """
    size = F.pow(F.lit(2.0), F.col("level")) * F.lit(unit * 1.001)
    t = train.select(
        *[F.col(f).alias(f"t_{f}") for f in features], "n", "s",
        F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"),
    ).withColumn("size", size)
    t = t.withColumns(_blocks("t_", features, scale)).drop("size")
    q = queries.select(*[F.col(f).alias(f"q_{f}") for f in features], "level").withColumn("size", size)
    q = q.withColumns(_blocks("q_", features, scale))
    for f in features:
        beside = F.explode(F.array(F.col(f"b_{f}") - 1, F.col(f"b_{f}"), F.col(f"b_{f}") + 1))
        q = q.withColumn(f"b_{f}", beside)
    pairs = q.join(t, ["level", *[f"b_{f}" for f in features]]).withColumn("d", _distance(features, scale))
    radius = F.col("size") / 1.001
    near = pairs.where(F.col("d") <= F.round(radius * radius, DISTANCE_DIGITS))
    return near.select(*[F.col(f"q_{f}").alias(f) for f in features], "d", "n", "s")


def _nearest_gap(x: Column, values: list[float]) -> Column:
    return F.array_min(F.transform(F.array(*[F.lit(v) for v in values]), lambda v: F.abs(v - x)))


def predict(train: DataFrame, queries: DataFrame, features: list[str], k: int = K,
            known: Profile | None = None) -> DataFrame:
    """Prediction ``knn`` per distinct query cell.

    ``train`` has one row per feature combination with row count ``n`` and sum of hundredths
    ``s``. A query whose own cell holds k rows needs no neighbour. The others look within a
    radius of their own, which starts just beyond the nearest possible neighbour and grows
    by doubling until k rows are found: crowded regions stay local, and only queries in sparse
    regions look far. Nothing is capped: the last radius of a query spans all cells.
    """
    known = known or profile(train, features)
    scale = known.scale

    # Per feature, the distance to the nearest value any training cell has, and to the farthest.
    # Together they bound the distance to the nearest and the farthest cell.
    nearest2, farthest2 = F.lit(0.0), F.lit(0.0)
    for f in features:
        values, x = known.values[f], F.col(f)
        near = _nearest_gap(x, values) / F.lit(scale[f])
        far = F.greatest(F.lit(values[-1]) - x, x - F.lit(values[0])) / F.lit(scale[f])
        nearest2, farthest2 = nearest2 + near * near, farthest2 + far * far
    steps = sorted(1.0 / s for s in scale.values())
    unit = steps[len(steps) // 2]

    def level_of(reach: Column) -> Column:
        """Lowest level whose radius covers ``reach``."""
        return F.greatest(F.ceil(F.log2(reach / F.lit(unit))), F.lit(0)).cast("int")

    todo = queries.select(*features).distinct().withColumns({
        "level": level_of(F.sqrt(nearest2) + F.lit(unit)), "last": level_of(F.sqrt(farthest2) + F.lit(1e-6)),
    })
    own = train.select(*features, F.lit(0.0).alias("d"), "n", "s")
    votes, step, finished = _vote(own, features, k), F.lit(0), F.lit(False)
    done: list[DataFrame] = []
    while True:
        enough = F.coalesce(F.col("found") >= k, F.lit(False))
        outcome = cut(todo.join(votes, features, "left").withColumn("settled", enough | finished))
        done.append(outcome.where("settled").select(*features, "knn"))
        todo = outcome.where("not settled").select(*features, (F.col("level") + step).alias("level"), "last")
        levels = sorted(r["level"] for r in todo.select("level").distinct().collect())
        if not levels:
            break
        votes = _vote(_within(train, todo, features, scale, unit, levels), features, k)
        step = F.when(F.col("found").isNull(), 2).otherwise(1)
        finished = F.col("level") >= F.col("last")
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result
