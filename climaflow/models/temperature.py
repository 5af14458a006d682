"""The temperature models: train, evaluate, save, load, predict."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.calendar import CALENDAR_FEATURES
from ..sinks.manifest import KEPT, Manifest
from . import knn, regressors, scores
from .features import MIN_ROWS, labelled, split_cells, training_cells

TREE_MODELS = ["ridge", "random_forest", "gradient_boosting"]
MODELS = scores.PRIORITY
# Fixed value: model used when saved metadata names no best one.
FALLBACK = "random_forest"

# Metadata field names, and the stored names of the models.
META_ERRORS = {"gradient_boosting": "gb", "random_forest": "rf", "ridge": "ridge", "knn": "knn"}
META_NAMES = {
    "ridge": "Ridge", "random_forest": "RandomForest", "gradient_boosting": "HistGradientBoosting", "knn": "KNN",
}
META_FEATURES = {
    "hour_of_day": "hora_dia", "day_of_week": "dia_semana", "month": "mes", "iso_week": "semana_anio",
}
META_SCHEMA = T.StructType(
    [T.StructField("mejor_modelo_nombre", T.StringType())]
    + [T.StructField(f"{kind}_{short}", T.DoubleType()) for short in META_ERRORS.values() for kind in ("mae", "r2")]
    + [T.StructField("total_eventos", T.LongType()), T.StructField("importancias", T.MapType(T.StringType(), T.DoubleType()))]
)


@dataclass
class TemperatureModels:
    """Fitted models over the calendar features. ``cells`` is the whole of the KNN model."""

    pipelines: dict[str, PipelineModel] = field(default_factory=dict)
    cells: DataFrame | None = None
    best: str = FALLBACK
    meta: dict = field(default_factory=dict)

    @cached_property
    def neighbours(self) -> knn.Profile:
        return knn.profile(self.cells, CALENDAR_FEATURES)

    @property
    def names(self) -> list[str]:
        return [m for m in MODELS if m in self.pipelines or (m == "knn" and self.cells is not None)]

    def predict(self, queries: DataFrame) -> DataFrame:
        """One prediction column per model for each distinct feature combination of ``queries``."""
        wanted = queries.select(*CALENDAR_FEATURES).distinct()
        out = wanted
        for name in TREE_MODELS:
            if name in self.pipelines:
                out = regressors.apply(self.pipelines[name], out)
        if self.cells is not None:
            near = knn.predict(self.cells, wanted, CALENDAR_FEATURES, known=self.neighbours)
            out = out.join(near, CALENDAR_FEATURES)
        return out

    def predict_rows(self, rows: DataFrame) -> DataFrame:
        """Rows with their predictions. Models run once per feature combination; the join side is
        bounded by the calendar."""
        return rows.join(self.predict(rows), CALENDAR_FEATURES)

    def long(self, wide: DataFrame, *keep: str) -> DataFrame:
        """Prediction columns as rows, with the best model's once more under ``best``."""
        pairs = [f"'{m}', {m}" for m in self.names] + [f"'best', {self.best}"]
        return wide.select(*keep, F.expr(f"stack({len(pairs)}, {', '.join(pairs)}) as (model, value)"))

    def importances(self, spark: SparkSession) -> DataFrame:
        """Forest feature importances, largest first, to three decimals."""
        found = importances(self.pipelines["random_forest"], CALENDAR_FEATURES)
        return importance_frame(spark, found)

    def save(self, spark: SparkSession, path: str) -> int:
        """Write a new version below ``path`` and make it the current one when it is whole; its number.

        Whoever loads meanwhile gets the version before. Older versions are deleted after a while.
        """
        manifest = Manifest(path)
        last, before = manifest.read(spark)
        version = last + 1
        name = f"version-{version}-{uuid.uuid4().hex[:8]}"
        for model, pipeline in self.pipelines.items():
            pipeline.write().overwrite().save(f"{path}/{name}/{model}")
        if self.cells is not None:
            self.cells.write.mode("overwrite").parquet(f"{path}/{name}/knn")
        spark.createDataFrame([self.meta], META_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/{name}/metadata")
        old = {**(before or {}).get("old", {}), **({str(last): before["folder"]} if before else {})}
        due = [v for v in old if int(v) <= version - KEPT]
        manifest.commit(spark, version, {"folder": name, "old": {v: n for v, n in old.items() if v not in due}})
        for v in due:
            manifest.delete(spark, old[v])
        return version

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TemperatureModels | None:
        """The current version saved at ``path``, or models that lie there without versions; none unless forest, boosting
        and metadata are all there. Without a named best model, or without that model, the forest is best."""
        _, current = Manifest(path).read(spark)
        if current is not None:
            path = f"{path}/{current['folder']}"
        if not all(_exists(spark, f"{path}/{p}") for p in ("random_forest", "gradient_boosting", "metadata")):
            return None
        meta = spark.read.schema(META_SCHEMA).json(f"{path}/metadata").first().asDict()
        found = {m: PipelineModel.load(f"{path}/{m}") for m in TREE_MODELS if _exists(spark, f"{path}/{m}")}
        cells = spark.read.parquet(f"{path}/knn") if _exists(spark, f"{path}/knn") else None
        models = cls(found, cells, FALLBACK, meta)
        named = {stored: m for m, stored in META_NAMES.items()}.get(meta["mejor_modelo_nombre"])
        models.best = named if named in models.names else FALLBACK
        return models


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def importances(forest: PipelineModel, features: list[str]) -> dict[str, float]:
    return dict(zip(features, (float(v) for v in forest.stages[-1].featureImportances.toArray())))


def importance_frame(spark: SparkSession, found: dict[str, float]) -> DataFrame:
    rows = spark.createDataFrame(list(found.items()), "feature string, importance double")
    return rows.select("feature", F.round("importance", 3).alias("importance")).orderBy(
        F.col("importance").desc(), "feature"
    )


def fit_pipelines(train: DataFrame, features: list[str], names: list[str] = TREE_MODELS) -> dict[str, PipelineModel]:
    """Fit several models at once; each is a series of small jobs that leave most cores idle."""
    fits = {
        "ridge": regressors.ridge, "random_forest": regressors.random_forest,
        "gradient_boosting": regressors.gradient_boosting,
    }
    session = train.sparkSession
    with ThreadPool(len(names)) as pool:
        work = inheritable_thread_target(session)(lambda name: fits[name](train, features))
        return dict(zip(names, pool.map(work, names)))


def train(df: DataFrame, zone: str | None = None, **split) -> tuple[TemperatureModels | None, str | None]:
    """Fit the four models on readings; the models, or none and the reason."""
    rows = labelled(df, **({"zone": zone} if zone else {}), **split)
    both = split_cells(rows)
    total = both.agg(F.sum("n")).first()[0] or 0
    if total < MIN_ROWS:
        return None, f"not enough rows: {total} of {MIN_ROWS}"
    cells = training_cells(both)
    models = TemperatureModels(fit_pipelines(cells, CALENDAR_FEATURES), cells.select(*CALENDAR_FEATURES, "n", "s"))
    found = {r["model"]: r for r in scores.ranked(evaluate(models, rows, both)).collect()}
    models.best = min(found.values(), key=lambda r: r["place"])["model"]
    models.meta = {
        "mejor_modelo_nombre": META_NAMES[models.best],
        **{f"mae_{short}": found[m]["mae"] for m, short in META_ERRORS.items()},
        **{f"r2_{short}": found[m]["r2"] for m, short in META_ERRORS.items()},
        "total_eventos": total,
        "importancias": {
            META_FEATURES[f]: round(v, 3)
            for f, v in importances(models.pipelines["random_forest"], CALENDAR_FEATURES).items()
        },
    }
    return models, None


def evaluate(models: TemperatureModels, rows: DataFrame, both: DataFrame | None = None) -> DataFrame:
    """Unrounded scores of every model over the test rows, without shuffling them.

    The predictions are broadcast: calendar features make at most 24 x 7 x 12 x 53 = 106,848 rows of
    under 100 bytes, whatever the number of readings.
    """
    both = split_cells(rows) if both is None else both
    predicted = models.predict(both.where("is_test"))
    test = rows.where("is_test").withColumn("actual", F.col("c") / 100.0)
    return scores.score_wide(test.join(F.broadcast(predicted), CALENDAR_FEATURES), "actual", models.names)


def fit_or_load(df: DataFrame, path: str, retrain: bool = False) -> tuple[TemperatureModels | None, str | None]:
    """Load the models saved at ``path``; train and save when there are none or on demand."""
    spark = df.sparkSession
    saved = None if retrain else TemperatureModels.load(spark, path)
    if saved is not None:
        return saved, None
    models, reason = train(df)
    if models is not None:
        models.save(spark, path)
    return models, reason
