"""Modelling queries."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import bands, calendar as cal
from ..functions.calendar import CALENDAR_FEATURES
from ..models import features as ft, horizons, knn, regressors, scores, temperature, trends
from ..session import run_dir, shared_dir
from ..sources.events import events, readings


def _rows(spark, d) -> DataFrame:
    return ft.labelled(readings(events(spark, d)))


_LOADED: dict[str, temperature.TemperatureModels] = {}


def _models(spark: SparkSession, d: str) -> temperature.TemperatureModels:
    """Models of this table: trained and saved once per application and content, then kept loaded."""
    rows = readings(events(spark, d))
    content = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("event_id", "ts", "temp").cast("decimal(38,0)"))).first()
    name = hashlib.sha1(f"{d} {content[0]} {content[1]}".encode()).hexdigest()[:12]
    path = f"{shared_dir(spark)}/models-{spark.sparkContext.applicationId}-{name}"
    if path not in _LOADED:
        models, reason = temperature.fit_or_load(rows, path)
        if models is None:
            raise ValueError(reason)
        _LOADED[path] = models
    return _LOADED[path]


def split_counts(spark, d):
    return ft.split_counts(_rows(spark, d))


def _knn(k: int):
    def query(spark, d):
        both = ft.split_cells(_rows(spark, d))
        return knn.predict(both.where(~F.col("is_test")), both.where("is_test"), CALENDAR_FEATURES, k)
    return query


def ridge_fit(spark, d):
    """Coefficients and intercept of the ridge model."""
    model = regressors.ridge(ft.training_cells(ft.split_cells(_rows(spark, d))), CALENDAR_FEATURES).stages[-1]
    terms = list(zip(CALENDAR_FEATURES, (float(c) for c in model.coefficients))) + [("intercept", float(model.intercept))]
    return spark.createDataFrame(terms, "term string, coefficient double").select("term", F.round("coefficient", 6).alias("coefficient"))


def model_metrics(spark, d):
    return scores.rounded(temperature.evaluate(_models(spark, d), _rows(spark, d)))


def best_model(spark, d):
    return scores.best(temperature.evaluate(_models(spark, d), _rows(spark, d)))


def _baselines(spark, d) -> DataFrame:
    """Three predictors made of columns: season curve, constant, half the humidity."""
    r = readings(events(spark, d))
    curve = bands.expected_temperature(F.dayofyear("ts"), F.hour("ts").cast("double"))
    return r.select("station", "temp", curve.alias("curve"), F.lit(10.0).alias("constant"), (F.col("humidity") / 2.0).alias("humid"))


def _six(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mae", "rmse", "r2")})


def baseline_scores(spark, d):
    """Score arithmetic on column-made predictors."""
    return _six(scores.score_wide(_baselines(spark, d), "temp", ["curve", "constant", "humid"]))


def baseline_best(spark, d):
    """Best predictor per station by rounded MAE, ties by fixed order."""
    names = ["curve", "constant", "humid"]
    scored = scores.score_wide(_baselines(spark, d), "temp", names, ["station"])
    return scores.best(scored, ["station"], names).select("station", "model", "mae")


def knn_metrics(spark, d):
    """Test scores of the nearest-neighbour model."""
    rows = _rows(spark, d)
    both = ft.split_cells(rows)
    model = temperature.TemperatureModels({}, both.where(~F.col("is_test")), "knn")
    return _six(temperature.evaluate(model, rows, both))


def rf_importance(spark, d):
    return _models(spark, d).importances(spark)


def gbt_predict(spark, d):
    """Boosting prediction of every feature combination of the test rows."""
    models = _models(spark, d)
    wanted = _rows(spark, d).where("is_test").select(*CALENDAR_FEATURES).distinct()
    out = regressors.apply(models.pipelines["gradient_boosting"], wanted)
    return out.withColumn("gradient_boosting", F.round("gradient_boosting", 2))


def predict_point(spark, d):
    """Point predictions for every feature combination that occurs in the table."""
    wanted = _rows(spark, d).select(*CALENDAR_FEATURES).distinct()
    return trends.predict_points(_models(spark, d), wanted)


def _last_day(spark, d):
    return events(spark, d).select(F.max("ts")).scalar().cast("date")


def _trend(mode: str):
    def query(spark, d):
        return trends.trend(_models(spark, d), trends.trend_grid(spark, mode, _last_day(spark, d)))
    return query


def trend_grids(spark, d):
    """Grid rows of all four modes from the newest date on, hours 20 to 5 put in order."""
    return trends.trend_grids(spark, _last_day(spark, d), 20, 5)


def trend_stats(spark, d):
    """Mean, least and largest trend value per mode and model."""
    grids = trends.trend_grids(spark, _last_day(spark, d))
    return scores.series_stats(trends.trend(_models(spark, d), grids, "mode"), "value", ("mode", "model"))


def series_stats(spark, d):
    """The same statistics over an hourly series: mean temperature per station and hour of day."""
    from ..functions.fixedpoint import hundredths, mean_of_hundredths

    r = readings(events(spark, d))
    series = r.groupBy("station", F.hour("ts").alias("h")).agg(F.sum(hundredths("temp")).alias("s"), F.count("temp").alias("n"))
    values = series.select(F.col("station").alias("model"), mean_of_hundredths("s", "n").alias("value"))
    return scores.series_stats(values)


def horizon_compare(spark, d):
    return horizons.compare(readings(events(spark, d)))


def model_roundtrip(spark, d):
    """Predictions of the models before saving and after loading, for every occurring combination."""
    models = _models(spark, d)
    path = run_dir(spark, "models")
    models.save(spark, path)
    loaded = temperature.TemperatureModels.load(spark, path)
    wanted = _rows(spark, d).select(*CALENDAR_FEATURES).distinct()
    a = models.long(models.predict(wanted), *CALENDAR_FEATURES).withColumnRenamed("value", "before")
    b = loaded.long(loaded.predict(wanted), *CALENDAR_FEATURES).withColumnRenamed("value", "after")
    joined = a.join(b, [*CALENDAR_FEATURES, "model"], "full")
    return joined.groupBy("model").agg(
        F.count(F.lit(1)).alias("points"),
        F.count(F.when(F.abs(F.col("before") - F.col("after")) < 1e-9, 1)).alias("equal_points"),
    )


QUERIES = {
    "split_counts": split_counts,
    "knn_predict": _knn(knn.K),
    "knn_predict_200": _knn(200),
    "knn_metrics": knn_metrics,
    "ridge_fit": ridge_fit,
    "baseline_scores": baseline_scores,
    "baseline_best": baseline_best,
    "series_stats": series_stats,
    "trend_grids": trend_grids,
    "model_metrics": model_metrics,
    "best_model": best_model,
    "rf_importance": rf_importance,
    "gbt_predict": gbt_predict,
    "predict_point": predict_point,
    "trend_day": _trend("day"),
    "trend_week": _trend("week"),
    "trend_month": _trend("month"),
    "trend_year": _trend("year"),
    "trend_stats": trend_stats,
    "horizon_compare": horizon_compare,
    "model_roundtrip": model_roundtrip,
}
