"""Commits that survive two writers and a rerun; dictionaries of any size;
leave-one-out errors."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import encode as E
from tabkit.operators import models as L
from tabkit.sources import io as S


def test_two_writers_both_land(spark, tmp_path):
    base, errors = str(tmp_path / "t"), []

    def write(k):
        try:
            S.rewrite_table(spark.range(k), base)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    writers = [threading.Thread(target=write, args=(k,)) for k in (3, 4, 5, 6)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert not errors and S.version_number(spark, base) == 4
    assert S.read_current(spark, base).count() in (3, 4, 5, 6)
    folders = [p for p in (tmp_path / "t").glob("w-*/v=*")]
    assert sorted(int(p.name[2:]) for p in folders) == [1, 2, 3, 4]
    assert sorted(spark.read.parquet(str(p)).count() for p in folders) == [3, 4, 5, 6]


def test_a_version_between_read_and_write_is_a_conflict(spark, tmp_path):
    base = str(tmp_path / "t")
    S.rewrite_table(spark.range(1), base)
    seen = S.version_number(spark, base)
    S.rewrite_table(spark.range(2), base)
    with pytest.raises(S.VersionConflict):
        S.rewrite_table(spark.range(3), base, read_version=seen)
    assert S.read_current(spark, base).count() == 2
    S.rewrite_table(spark.range(3), base, read_version=2)
    assert S.read_current(spark, base).count() == 3


def test_logging_a_batch_again_adds_nothing(spark, tmp_path):
    path, m = str(tmp_path / "log"), spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 4.0)], "fold int, a double, b double")
    assert S.log_metrics(m, path, "run", ["fold"], ["a", "b"]).count() == 4
    assert S.log_metrics(m, path, "run", ["fold"], ["a", "b"]).count() == 0
    assert spark.read.parquet(path).count() == 4
    S.log_metrics(m, path, "run", ["fold"], ["a", "b"], batch="1")
    S.log_metrics(m, path, "other", ["fold"], ["a", "b"])
    assert spark.read.parquet(path).groupBy("run_id").count().orderBy("run_id").collect()[1]["count"] == 8


def test_ordinal_tables(spark):
    rows = [("b",), (None,), ("a",), ("b",), ("ä",)]
    d = spark.createDataFrame(rows, "v string")
    table = E.fit_ordinal_table(d, "v")
    assert {r.level: r.code for r in table.collect()} == {"a": 0, "b": 1, "ä": 2}
    for n in (10, 0):
        got = E.apply_ordinal_table(d.union(spark.createDataFrame([("new",)], "v string")), "v", table, "c", n)
        assert {r.v: r.c for r in got.collect()} == {"a": 0, "b": 1, "ä": 2, None: None, "new": None}
    many = spark.range(5000).select(F.col("id").alias("v")).repartition(7)
    assert E.fit_ordinal_table(many, "v").where("level <> code").count() == 0
    assert E.fit_ordinal_table(many.where("v < 0"), "v").count() == 0


def test_leave_one_out_is_refitting(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 2))
    y = x @ [2.0, -1.0] + rng.normal(size=40)
    d = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double").repartition(3)
    model, scores = L.train_ridge_loo(d, ["a", "b"], "y", [0.5, 30.0])
    for r in scores.collect():
        errors = []
        for i in range(40):
            keep = np.arange(40) != i
            xc, yc = x[keep] - x[keep].mean(0), y[keep] - y[keep].mean()
            w = np.linalg.solve(xc.T @ xc + r.alpha * np.eye(2), xc.T @ yc)
            errors.append(y[i] - y[keep].mean() - (x[i] - x[keep].mean(0)) @ w)
        assert r.loo_mse == pytest.approx(np.mean(np.square(errors)))
    assert model.alpha == 0.5
