"""The MLlib regressors and their fixed parameters."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

# Ridge penalty, forest size, boosting length and rate, seed.
ALPHA = 1.0
TREES = 50
BOOST_ROUNDS = 100
BOOST_RATE = 0.1
SEED = 42
# Bins cover the 53 ISO weeks, so every split point of a calendar feature is tried.
BINS = 64


def _pipeline(features: list[str], regressor) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), regressor])


def ridge(train: DataFrame, features: list[str], alpha: float = ALPHA) -> PipelineModel:
    """Ridge on standardised features, by the distributed normal equations.

    The library divides its penalty by the label deviation and by the total weight, so both
    are multiplied back to get the penalty ``alpha`` of the closed form.
    """
    n, s1, s2 = train.agg(
        F.sum("weight"), F.sum(F.col("weight") * F.col("label")), F.sum(F.col("weight") * F.col("label") * F.col("label"))
    ).first()
    spread = math.sqrt(max(s2 / n - (s1 / n) ** 2, 0.0))
    return _pipeline(features, LinearRegression(
        labelCol="label", weightCol="weight", predictionCol="ridge",
        elasticNetParam=0.0, regParam=alpha / n * spread, solver="normal", standardization=True,
    )).fit(train)


def random_forest(train: DataFrame, features: list[str], trees: int = TREES, depth: int = 10) -> PipelineModel:
    return _pipeline(features, RandomForestRegressor(
        labelCol="label", weightCol="weight", predictionCol="random_forest", numTrees=trees, seed=SEED,
        featureSubsetStrategy="all", maxDepth=depth, maxBins=BINS,
    )).fit(train)


def gradient_boosting(train: DataFrame, features: list[str], rounds: int = BOOST_ROUNDS, depth: int = 5) -> PipelineModel:
    return _pipeline(features, GBTRegressor(
        labelCol="label", weightCol="weight", predictionCol="gradient_boosting", maxIter=rounds,
        stepSize=BOOST_RATE, maxDepth=depth, maxBins=BINS, seed=SEED,
    )).fit(train)


def apply(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")
