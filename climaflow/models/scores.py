"""Error figures of predictions and the choice of the best model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Model names in the order that decides ties.
PRIORITY = ["ridge", "random_forest", "gradient_boosting", "knn"]


def score_wide(df: DataFrame, actual: str, models: list[str], keys: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and R2 of prediction columns against ``actual``, in one pass; one row per model."""
    keys = keys or []
    y = F.col(actual)
    sums = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("y1"), F.sum(y * y).alias("y2")]
    for m in models:
        e = y - F.col(m)
        sums += [F.sum(F.abs(e)).alias(f"{m}_a"), F.sum(e * e).alias(f"{m}_s")]
    one = df.groupBy(*keys).agg(*sums) if keys else df.agg(*sums)
    rows = ", ".join(f"'{m}', {m}_a, {m}_s" for m in models)
    long = one.where("n > 0").select(*keys, "n", "y1", "y2", F.expr(f"stack({len(models)}, {rows}) as (model, a, s)"))
    spread = F.col("y2") - F.col("y1") * F.col("y1") / F.col("n")
    return long.select(
        *keys,
        "model",
        F.col("n").alias("rows"),
        (F.col("a") / F.col("n")).alias("mae"),
        F.sqrt(F.col("s") / F.col("n")).alias("rmse"),
        (1 - F.try_divide(F.col("s"), spread)).alias("r2"),
    )


def rounded(scores: DataFrame) -> DataFrame:
    """MAE and RMSE to two decimals, R2 to three."""
    return scores.withColumns({"mae": F.round("mae", 2), "rmse": F.round("rmse", 2), "r2": F.round("r2", 3)})


def ranked(scores: DataFrame, keys: list[str] | None = None, priority: list[str] = PRIORITY) -> DataFrame:
    """Scores with their rank by rounded MAE; ties go by the fixed order. A few rows per key."""
    from pyspark.sql import Window as W

    place = F.array_position(F.array(*[F.lit(m) for m in priority]), F.col("model"))
    w = W.partitionBy(*(keys or [F.lit(0)])).orderBy("mae", place)
    return rounded(scores).withColumn("place", F.row_number().over(w))


def best(scores: DataFrame, keys: list[str] | None = None, priority: list[str] = PRIORITY) -> DataFrame:
    return ranked(scores, keys, priority).where("place = 1").drop("place")


def series_stats(df: DataFrame, value: str = "value", keys: tuple[str, ...] = ("model",)) -> DataFrame:
    """Mean, least and largest of an already rounded series, to two decimals."""
    cents = F.rint(F.col(value) * 100).cast("bigint")
    sums = df.groupBy(*keys).agg(F.sum(cents).alias("s"), F.count(value).alias("n"), F.min(cents).alias("lo"), F.max(cents).alias("hi"))
    from ..functions.fixedpoint import mean_of_hundredths

    return sums.select(*keys, mean_of_hundredths("s", "n").alias("avg"), (F.col("lo") / 100.0).alias("min"), (F.col("hi") / 100.0).alias("max"))
