"""Models against closed forms and brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from climaflow.functions.calendar import CALENDAR_FEATURES
from climaflow.models import features as ft, knn, regressors, scores, temperature, trends
from climaflow.sources.events import events, readings


@pytest.fixture(scope="module")
def cells(spark):
    """Weighted cells over two features, and the rows behind them."""
    rng = random.Random(5)
    rows = [(rng.randrange(24), rng.randrange(7), rng.randrange(-500, 3000)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, c long").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("s"))
    return rows, df.withColumns({"label": F.col("s") / F.col("n") / 100.0, "weight": F.col("n").cast("double")}).checkpoint()


def test_ridge_equals_closed_form(cells):
    rows, df = cells
    x = np.array([r[:2] for r in rows], float)
    y = np.array([r[2] / 100 for r in rows])
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (y - y.mean()))
    model = regressors.ridge(df, ["a", "b"]).stages[-1]
    np.testing.assert_allclose(np.array(model.coefficients.toArray()), w / x.std(0), rtol=1e-7)
    assert model.intercept == pytest.approx(y.mean() - (w / x.std(0)) @ x.mean(0), rel=1e-7)


def brute_knn(train, scale, query, k):
    groups = {}
    for (a, b), (n, s) in train.items():
        d = round(((query[0] - a) / scale["a"]) ** 2 + ((query[1] - b) / scale["b"]) ** 2, 9)
        g = groups.setdefault(d, [0, 0])
        g[0] += n
        g[1] += s
    need, total = k, 0.0
    for d in sorted(groups):
        n, s = groups[d]
        take = min(n, need)
        total, need = total + take * s / n, need - take
        if not need:
            break
    return total / (k - need) / 100


@pytest.mark.parametrize("k", [1, 5, 40, 399, 1000])
def test_knn_equals_brute_force(spark, cells, k):
    _, df = cells
    scale = knn.profile(df, ["a", "b"]).scale
    train = {(r["a"], r["b"]): (r["n"], r["s"]) for r in df.collect()}
    wanted = list(itertools.product([-40, 0, 3, 23, 60], [0, 6, 30]))
    got = knn.predict(df, spark.createDataFrame(wanted, "a int, b int"), ["a", "b"], k)
    got = {(r["a"], r["b"]): r["knn"] for r in got.collect()}
    assert set(got) == set(wanted)
    for q in wanted:
        assert got[q] == pytest.approx(brute_knn(train, scale, q, k), abs=1e-9)


def test_scores(spark):
    df = spark.createDataFrame([(1.0, 1.5, 2.0), (3.0, 2.0, 2.0), (5.0, 5.0, 8.0)], "y double, m double, z double")
    got = {r["model"]: r for r in scores.score_wide(df, "y", ["m", "z"]).collect()}
    assert got["m"]["mae"] == pytest.approx(0.5) and got["m"]["r2"] == pytest.approx(1 - 1.25 / 8)
    assert got["z"]["rmse"] == pytest.approx(math.sqrt(11 / 3))
    flat = scores.score_wide(df.withColumn("y", F.lit(2.0)), "y", ["m"]).first()
    assert flat["r2"] is None


def test_best_model_tie_goes_by_order(spark):
    df = spark.createDataFrame(
        [("knn", 1.001, 1.0, 0.5), ("gradient_boosting", 1.004, 1.0, 0.5), ("random_forest", 1.002, 1.0, 0.5), ("ridge", 1.2, 1.0, 0.5)],
        "model string, mae double, rmse double, r2 double")
    assert scores.best(df).first()["model"] == "random_forest"


def test_too_few_rows(spark, small, tmp_path):
    few = readings(events(spark, small)).where("event_id < 19")
    models, reason = temperature.fit_or_load(few, str(tmp_path))
    assert models is None and "19" in reason


def test_split_is_every_fifth_key(spark, small):
    rows = ft.labelled(readings(events(spark, small)))
    got = {r["split"]: r["rows"] for r in ft.split_counts(rows).collect()}
    assert got == {"test": 200, "train": 800}


def test_loader_falls_back_to_forest(spark, small, tmp_path, monkeypatch):
    """Metadata that names no best model, and no ridge or neighbour model on disk."""
    monkeypatch.setattr(regressors, "BOOST_ROUNDS", 2)
    rows = ft.labelled(readings(events(spark, small)))
    train = ft.training_cells(ft.split_cells(rows))
    found = {
        "random_forest": regressors.random_forest(train, CALENDAR_FEATURES, trees=3, depth=3),
        "gradient_boosting": regressors.gradient_boosting(train, CALENDAR_FEATURES, rounds=2),
    }
    for name, model in found.items():
        model.write().overwrite().save(f"{tmp_path}/{name}")
    assert temperature.TemperatureModels.load(spark, str(tmp_path)) is None
    spark.createDataFrame([('{"mae_rf": 1.5, "importancias": {"mes": 0.5}}',)], "value string").write.text(f"{tmp_path}/metadata")
    loaded = temperature.TemperatureModels.load(spark, str(tmp_path))
    assert loaded.best == "random_forest" and loaded.names == ["random_forest", "gradient_boosting"]
    assert loaded.meta["mae_rf"] == 1.5 and loaded.meta["importancias"] == {"mes": 0.5}
    wanted = rows.select(*CALENDAR_FEATURES).limit(5)
    points = trends.predict_points(loaded, wanted).collect()
    assert all(p["best"] == p["random_forest"] for p in points)
    again, reason = temperature.fit_or_load(readings(events(spark, small)), str(tmp_path))
    assert reason is None and again.best == "random_forest"


@pytest.mark.parametrize("mode,points,grid", [("day", 24, 24), ("week", 7, 168), ("month", 30, 720), ("year", 12, 2016)])
def test_trend_grid_sizes(spark, mode, points, grid):
    got = trends.trend_grid(spark, mode, F.lit("2024-11-28").cast("date"))
    assert got.count() == grid and got.select("position").distinct().count() == points
    first = got.orderBy("position", "hour_of_day").first()
    assert first["label"] == {"day": "00:00h", "week": "Jueves", "month": "28/11", "year": "Noviembre"}[mode]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        trends.trend_grid(spark, "decade", F.lit("2024-11-28").cast("date"))


def test_forest_importances_are_sorted(spark):
    got = temperature.importance_frame(spark, {"a": 0.1236, "b": 0.5, "c": 0.3764}).collect()
    assert [(r["feature"], r["importance"]) for r in got] == [("b", 0.5), ("c", 0.376), ("a", 0.124)]


def brute_neighbours(rows, labels, scale, query, k):
    """Mean label of the k nearest rows; those at the k-th distance share the places left."""
    d = [round(sum(((q - v) / s) ** 2 for q, v, s in zip(query, r, scale)), 9) for r in rows]
    total, need = 0.0, k
    for at in sorted(set(d)):
        ys = [y for y, x in zip(labels, d) if x == at]
        take = min(len(ys), need)
        total, need = total + take * sum(ys) / len(ys), need - take
        if not need:
            break
    return total / (k - need)


@pytest.mark.parametrize("k,pivots", [(1, 1), (5, 7), (5, 256), (400, 9)])
def test_neighbours_in_eight_real_dimensions_equal_brute_force(spark, k, pivots):
    rng = random.Random(k + pivots)
    names = [f"f{i}" for i in range(8)]
    rows = [[rng.gauss(0, 1 + i) for i in range(7)] + [3.5] for _ in range(300)]
    rows += [rows[0]] * 6 + [[v + 40 for v in r] for r in rows[:20]]
    labels = [round(rng.uniform(-20, 40), 2) for _ in rows]
    wanted = rows[::15] + [[rng.gauss(0, 9) for _ in range(8)] for _ in range(20)] + [[1e4] * 8]
    train = spark.createDataFrame([(*r, y) for r, y in zip(rows, labels)] + [(*rows[0][:7], None, 5.0)], ", ".join(f"{n} double" for n in [*names, "y"]))
    asked = spark.createDataFrame([(i, *r) for i, r in enumerate(wanted)] + [(None, *wanted[0]), (999, None, *wanted[0][1:])],
                                  "id int, " + ", ".join(f"{n} double" for n in names))
    from climaflow.models import metric_knn

    scale = [s if (s := float(np.std([r[i] for r in rows]))) > 1e-9 else 1.0 for i in range(8)]
    got = metric_knn.predict(train.repartition(3), asked.repartition(3), names, "y", k, pivots).collect()
    assert len(got) == len(wanted) + 2 and got[0].asDict().keys() == {"id", *names, "knn"}
    for r in got:
        want = None if r["id"] == 999 else brute_neighbours(rows, labels, scale, wanted[r["id"] or 0], k)
        assert r["knn"] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_neighbours_of_nothing(spark):
    from climaflow.models import metric_knn

    empty = spark.createDataFrame([], "a double, y double")
    one = spark.createDataFrame([(1.0,)], "a double")
    assert [r["knn"] for r in metric_knn.predict(empty, one, ["a"], "y").collect()] == [None]
    assert metric_knn.predict(one.withColumn("y", F.lit(2.0)), one.where("false"), ["a"], "y").collect() == []


def constant_models(spark, value):
    """Models that say ``value`` everywhere, quickly fitted."""
    cells = spark.createDataFrame([(h, 0, 1, 1, 1, int(value * 100)) for h in range(3)], "hour_of_day int, day_of_week int, month int, iso_week int, n bigint, s bigint")
    train = cells.withColumns({"label": F.lit(float(value)), "weight": F.lit(1.0)})
    found = {"random_forest": regressors.random_forest(train, CALENDAR_FEATURES, trees=1, depth=1),
             "gradient_boosting": regressors.gradient_boosting(train, CALENDAR_FEATURES, rounds=1)}
    meta = {"mejor_modelo_nombre": "KNN", "total_eventos": value, "importancias": {}, **{f"{k}_{m}": 1.0 for k in ("mae", "r2") for m in ("gb", "rf", "ridge", "knn")}}
    return temperature.TemperatureModels(found, cells, "knn", meta)


def test_a_version_is_seen_whole_while_another_is_saved(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    says = lambda m: {round(r[0], 6) for r in m.predict(m.cells.select(*CALENDAR_FEATURES)).select(F.explode(F.array(*m.names))).collect()}
    assert temperature.TemperatureModels.load(spark, path) is None
    assert constant_models(spark, 1).save(spark, path) == 1
    first = temperature.TemperatureModels.load(spark, path)
    assert says(first) == {1.0} and first.best == "knn"
    # The writer is ended after its models, before its metadata.
    broken = constant_models(spark, 2)
    monkeypatch.setitem(broken.meta, "total_eventos", "not a number")
    with pytest.raises(Exception):
        broken.save(spark, path)
    again = temperature.TemperatureModels.load(spark, path)
    assert says(again) == {1.0} and again.meta["total_eventos"] == 1
    for value in (3, 4, 5, 6):
        constant_models(spark, value).save(spark, path)
        if value == 3:
            assert says(first) == {1.0}  # begun before the new version
    assert says(temperature.TemperatureModels.load(spark, path)) == {6.0}
    assert len(list(tmp_path.glob("version-*"))) <= 4


def test_models_are_trained_again_on_demand(spark, small, tmp_path, monkeypatch):
    made = iter([constant_models(spark, 7), constant_models(spark, 8)])
    monkeypatch.setattr(temperature, "train", lambda df: (next(made), None))
    df = readings(events(spark, small))
    assert temperature.fit_or_load(df, str(tmp_path))[0].meta["total_eventos"] == 7
    assert temperature.fit_or_load(df, str(tmp_path))[0].meta["total_eventos"] == 7
    assert temperature.fit_or_load(df, str(tmp_path), retrain=True)[0].meta["total_eventos"] == 8
    assert temperature.TemperatureModels.load(spark, str(tmp_path)).meta["total_eventos"] == 8


def test_horizon_features_are_all_used():
    from climaflow.models import horizons

    assert len(horizons.FEATURES) == 8 and not hasattr(horizons, "KNN_FEATURES")
