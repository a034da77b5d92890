"""Settings of the registered model queries, without the fits."""

import pytest

from tabkit.operators import models as L
from tabkit.plans import q_models as Q


class Seen(Exception):
    pass


def seen(*args, **kwargs):
    raise Seen(args, kwargs)


def call(monkeypatch, name, query, spark, sf_dir):
    """Arguments with which ``query`` first calls the operator ``name``."""
    monkeypatch.setattr(L, name, seen)
    with pytest.raises(Seen) as e:
        query(spark, sf_dir)
    return e.value.args


def test_submission_is_fitted_with_the_default_boosting(spark, sf_dir, monkeypatch):
    args, _ = call(monkeypatch, "fit_predict_submit", Q.q_fit_predict_submit, spark, sf_dir)
    gbt = args[2].getStages()[-1]
    assert {k: gbt.getOrDefault(k) for k in L.GBT_REGRESSOR_DEFAULTS} == L.GBT_REGRESSOR_DEFAULTS


def test_candidates_differ_from_the_defaults_in_depth_only(spark, sf_dir, monkeypatch):
    args, _ = call(monkeypatch, "train_gbt_classifier", Q.q_select_best, spark, sf_dir)
    assert args[3] == {"max_depth": 1}


@pytest.mark.parametrize("name,query", [("train_rf_regressor", Q.q_rf_regressor), ("train_rf_classifier", Q.q_rf_classifier)])
def test_forests_grow_whole_trees(spark, sf_dir, monkeypatch, name, query):
    _, options = call(monkeypatch, name, query, spark, sf_dir)
    assert options == {"id_col": "id"}


def test_report_and_search_have_the_original_rounds(spark, sf_dir, monkeypatch):
    _, options = call(monkeypatch, "cv_report", Q.q_cv_report, spark, sf_dir)
    assert options["params"] == {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0}
    args, options = call(monkeypatch, "random_search", Q.q_random_search, spark, sf_dir)
    assert len(args) == 4 and options == {}
    args, options = call(monkeypatch, "importance_study", Q.q_importance_study, spark, sf_dir)
    assert len(args) == 4 and options == {"frac": 0.4}
