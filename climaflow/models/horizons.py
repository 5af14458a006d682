"""Comparison of the models 1, 24 and 168 hours ahead."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ..operators.hourly import HORIZONS, LAGS, ROLLING, forecast_frame
from ..session import cut
from . import metric_knn, regressors, scores
from .temperature import TREE_MODELS, fit_pipelines

FEATURES = ["hour_sin", "hour_cos", *[f"lag_{n}" for n in LAGS], *[f"roll_{n}" for n in ROLLING]]
TRAIN_SHARE = 0.8


def prepared(df: DataFrame) -> DataFrame:
    """Complete feature rows, written once for all fits."""
    frame = forecast_frame(df).dropna(subset=FEATURES)
    return cut(frame.select("station", "hr", *FEATURES, *[f"target_{h}" for h in HORIZONS]))


def _compare_one(frame: DataFrame, horizon: int) -> DataFrame:
    rows = frame.where(F.col(f"target_{horizon}").isNotNull()).withColumns({
        "label": F.col(f"target_{horizon}"), "weight": F.lit(1.0),
    })
    bounds = rows.agg(F.min(F.unix_seconds(F.col("hr").cast("timestamp"))), F.max(F.unix_seconds(F.col("hr").cast("timestamp")))).first()
    border = bounds[0] + TRAIN_SHARE * (bounds[1] - bounds[0])
    second = F.unix_seconds(F.col("hr").cast("timestamp"))
    # A training label must lie before the border as well: at long horizons it would otherwise be test data.
    past, ahead = second + horizon * 3600 <= border, second > border
    train, test = rows.where(past), rows.where(ahead)
    predicted = test
    for model in fit_pipelines(train, FEATURES).values():
        predicted = regressors.apply(model, predicted)
    predicted = metric_knn.predict(train, predicted, FEATURES, "label")
    scored = scores.score_wide(predicted, "label", [*TREE_MODELS, "knn"])
    return scores.ranked(scored).select(F.lit(horizon).alias("horizon_h"), "*")


def compare(df: DataFrame, horizons=HORIZONS) -> DataFrame:
    """MAE, RMSE, R2 and place of every model at each horizon; the newest fifth of time is the test."""
    frame = prepared(df)
    with ThreadPool(len(horizons)) as pool:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(lambda h: _compare_one(frame, h)), horizons)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
