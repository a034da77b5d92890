"""Invariants of the model operators on inline rows."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabkit.operators import metrics as K
from tabkit.operators import models as L


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    a, b, c = rng.normal(size=(3, 400))
    y = 3 * a - 2 * b + 0.5 + rng.normal(scale=0.1, size=400)
    rows = [(i, float(a[i]), float(b[i]), float(c[i]), float(y[i]), float(y[i] > 0.5), "xyz"[i % 3]) for i in range(400)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, k double, g string").cache()


FEATS = ["a", "b", "c"]


def rmse(df, label="y"):
    return math.sqrt(df.agg(F.avg((F.col("prediction") - F.col(label)) ** 2)).first()[0])


def spread(df, label="y"):
    return df.agg(F.stddev_pop(label)).first()[0]


def arrays(df):
    rows = df.orderBy("id").collect()
    return np.array([[r.a, r.b, r.c] for r in rows]), np.array([r.y for r in rows])


def test_forests_beat_the_mean_and_take_settings(data):
    m = L.train_rf_regressor(data, FEATS, "y", num_trees=10)
    assert rmse(m.transform(data)) < 0.4 * spread(data)
    assert len(m.tops) == 10 and m.n_nodes > 10 * 100
    m = L.train_rf_regressor(data, FEATS, "y", num_trees=3, max_depth=4, max_features="sqrt", min_leaf=9)
    assert m.n_nodes <= 3 * 31


def test_forest_classifier_ignores_unseen_levels(data):
    m = L.train_rf_classifier(data, ["g"], FEATS, "k", num_trees=10)
    scored = m.transform(data.withColumn("g", F.lit("new")))
    assert scored.count() == 400
    assert K.accuracy(m.transform(data), "k", "prediction").first()[0] > 0.9


@pytest.mark.parametrize("alpha", [0.1, 10.0, 1000.0])
def test_ridge_is_the_closed_form(data, alpha):
    x, y = arrays(data)
    m = L.fold_moments(data, FEATS, "y", F.lit(0))[0]
    xc, yc = x - x.mean(0), y - y.mean()
    assert L.solve_ridge(m, alpha) == pytest.approx(np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc), rel=1e-9)
    assert L.solve_ridge(L.fold_moments(data, ["a"], "y", F.lit(0))[0], alpha)[0] == pytest.approx(
        (xc[:, 0] @ yc) / (xc[:, 0] @ xc[:, 0] + alpha), rel=1e-9)


def test_cv_scores_are_those_of_refits(data):
    x, y = arrays(data)
    folds = np.array([r.f for r in L.k_fold(data, "id", 5, "cv42", "f").orderBy("id").collect()])
    for train, alphas in ((L.train_ridge_cv, [0.1, 100.0]), (L.train_lasso_cv, [0.01, 0.5])):
        model, scores = train(data, FEATS, "y", "id", alphas)
        for r in scores.collect():
            errors = []
            for f in range(5):
                xt, yt = x[folds != f], y[folds != f]
                xc, yc = xt - xt.mean(0), yt - yt.mean()
                if train is L.train_ridge_cv:
                    w = np.linalg.solve(xc.T @ xc + r.alpha * np.eye(3), xc.T @ yc)
                else:
                    w = np.zeros(3)
                    for _ in range(2000):
                        w -= 0.1 * xc.T @ (xc @ w - yc) / len(yc)
                        w = np.sign(w) * np.maximum(np.abs(w) - 0.1 * r.alpha, 0)
                errors.append(np.mean((y[folds == f] - (x[folds == f] - xt.mean(0)) @ w - yt.mean()) ** 2))
            assert r.cv_mse == pytest.approx(np.mean(errors), rel=2e-3)
        assert model.alpha == min(scores.collect(), key=lambda r: r.cv_mse).alpha
        assert rmse(model.transform(data)) < 0.5


def test_missing_values_are_an_error(data):
    with pytest.raises(Exception, match="missing or infinite"):
        L.fold_moments(data.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), FEATS, "y", F.lit(0))


def test_lasso_drops_useless_features(data):
    m = L.fold_moments(data, FEATS, "y", F.lit(0))[0]
    w = L.solve_lasso(m, 0.2, tolerance=1e-12)
    assert w[2] == 0 and abs(w[0]) > 2
    assert not L.solve_lasso(m, L.lasso_alpha_grid(m)[0] * 1.0001).any()


def test_stack_and_out_of_fold(data):
    bases = {"ridge": L.spark_learner(lambda d: L.train_ridge_cv(d, FEATS, "y", "id")[0]),
             "knn": L.knn_learner("id", FEATS, "y", 5)}
    stack = L.train_stack(data, bases, "y", "id", k=3)
    out = stack.transform(data)
    assert out.count() == 400 and rmse(out) < 0.6 * spread(data)
    oof = L.oof_predict(data, bases["ridge"], "id", 4)
    assert oof.count() == 400 and oof.select("id").distinct().count() == 400


def test_kernel_model_beats_the_mean(data):
    m = L.train_rbf_regressor(data, FEATS, "y", gamma=0.05, n_components=60, c=10.0)
    assert rmse(m.transform(data)) < 0.5 * spread(data)


def test_search_scores_every_draw(data):
    grid = dict(L.SEARCH_GRID, n_estimators=[3, 5])
    model, draws = L.random_search(data, FEATS, "y", "id", grid, n_iter=2, k=2)
    rows = draws.collect()
    assert len(rows) == 2 and all(r.cv_mae > 0 for r in rows) and len({tuple(r)[1:-1] for r in rows}) == 2
    assert rmse(model.transform(data)) < spread(data)


def test_importance_study_has_all_seeds_and_sums_to_one(data):
    long = L.importance_study(data, FEATS, "k", "id", n=2, params={"n_estimators": 3, "max_depth": 3})
    sums = {r.seed: r.s for r in long.groupBy("seed").agg(F.sum("importance").alias("s")).collect()}
    assert sums == {0: pytest.approx(1.0), 1: pytest.approx(1.0)} and long.count() == 6
    assert L.importance_summary(long).count() == 3


def test_cv_report_has_every_cell(data):
    rows = L.cv_report(data, FEATS, "k", "id", k=2, params={"n_estimators": 3, "learning_rate": 0.5}).collect()
    assert {(r.fold, r.side, r.metric) for r in rows} == {(f, s, m) for f in (0, 1) for s in ("train", "valid") for m in ("accuracy", "auc")}
    assert all(0.5 < r.value <= 1 for r in rows)


def test_staged_class_error_equals_truncated_models(data):
    m = L.train_gbt_classifier(data, FEATS, "k", {"n_estimators": 6, "learning_rate": 0.3})
    curve = {r.iteration: r.class_error for r in L.staged_class_error(m, data, "k").collect()}
    x, _ = arrays(data)
    k = np.array([r.k for r in data.orderBy("id").collect()])
    gbt = m.stages[-1]
    margin = np.zeros(len(k))
    for i, (tree, w) in enumerate(zip(gbt.trees, gbt.treeWeights)):
        margin += w * np.array([tree.predict(__import__("pyspark").ml.linalg.Vectors.dense(row)) for row in x])
        assert curve[i + 1] == pytest.approx(np.mean((margin > 0) != (k == 1)))
    assert len(curve) == 6


def test_early_stopping_stops(data):
    d = data.withColumn("val", F.col("id") % 4 == 0)
    m = L.train_with_validation(d, FEATS, "y", "val", {"n_estimators": 60, "learning_rate": 0.5}, tol=0.05)
    assert m.stages[-1].getNumTrees < 60


def test_mlp_learns_with_weights(data):
    from tabkit.operators.scale import apply_standard
    weighted = data.withColumn("w", F.when(F.col("k") == 1, 1.5).otherwise(1.0))
    m, std = L.train_mlp_classifier(weighted, FEATS, "k", "id", hidden=(4,), weight_col="w", max_iter=40)
    assert K.accuracy(m.transform(apply_standard(data, std)), "k", "prediction").first()[0] > 0.9


def test_submission_has_the_test_ids(data, tmp_path):
    from tabkit.sources.io import read_table
    pipe = L.make_pipeline([L.assembler(FEATS), L.GBTRegressor(labelCol="y", maxIter=2)])
    test = data.where("id % 5 = 0")
    L.fit_predict_submit(data.where("id % 5 <> 0"), test, pipe, "id", f"{tmp_path}/s")
    ids = [r.id for r in read_table(data.sparkSession, f"{tmp_path}/s", "id long, prediction double").collect()]
    assert sorted(ids) == [r.id for r in test.orderBy("id").collect()]


def test_select_best_saves_only_the_best(data, tmp_path):
    models = {d: L.train_gbt_regressor(data, FEATS, "y", {"n_estimators": 5, "max_depth": d, "learning_rate": 0.3}) for d in (1, 3)}
    best, model, values = L.select_best(models, lambda m: rmse(m.transform(data)), "min", f"{tmp_path}/m")
    assert best == 3 and values[3] < values[1] and model is models[3]
    assert rmse(PipelineModel.load(f"{tmp_path}/m").transform(data)) == pytest.approx(values[3])
    assert L.select_best(models, lambda m: rmse(m.transform(data)) if m is models[1] else math.nan, "min")[0] == 1
    with pytest.raises(ValueError):
        L.select_best(models, lambda m: math.nan)
