"""Fits that pass over their rows many times have them on all cores, also when
a file of one row group left them in one partition (F2, F5, F6, F10, F11, F13)."""

from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabkit.functions import frames
from tabkit.operators import boosting as B
from tabkit.operators import forests as R
from tabkit.operators import models as L


@pytest.fixture()
def lumped(spark, monkeypatch):
    """800 rows in one of three partitions; keys repeat or are null."""
    monkeypatch.setattr(frames, "DEAL_ROWS", 100)
    return spark.range(800, numPartitions=1).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 50).alias("id"), (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 3).cast("double").alias("b"), ((F.col("id") % 7) * (F.col("id") % 3)).cast("double").alias("y"),
        (F.col("id") % 2).cast("double").alias("k")).union(spark.createDataFrame([], "id long, a double, b double, y double, k double"))


def sizes(df):
    return [len(part) for part in df.rdd.glom().collect()]


def even(df, spark):
    found = sizes(df)
    return len(found) == spark.sparkContext.defaultParallelism and max(found) - min(found) <= len(found)


def held(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_rows_are_dealt_evenly_and_released(spark, lumped, monkeypatch):
    before = held(spark)
    with frames.dealt_rows(lumped) as rows:
        assert even(rows, spark) and Counter(rows.collect()) == Counter(lumped.collect())
    assert held(spark) == before
    with frames.dealt_rows(lumped, 801) as rows:
        assert max(sizes(rows)) == 800
    kept = lumped.persist()
    kept.count()
    with frames.dealt_rows(kept) as rows:
        assert even(rows, spark)
    assert kept.storageLevel.useMemory and held(spark) == before + 1
    kept.unpersist()
    with pytest.raises(RuntimeError):
        with frames.dealt_rows(lumped):
            raise RuntimeError
    assert held(spark) == before


@pytest.mark.parametrize("module", [R, B, L])
def test_blocks_are_packed_on_all_cores(spark, lumped, monkeypatch, module):
    """forests, boosting and nets."""
    seen, pack = [], module.pack_blocks
    monkeypatch.setattr(module, "pack_blocks", lambda df, *a, **k: seen.append(even(df, spark)) or pack(df, *a, **k))
    if module is R:
        R.train_forest(lumped, ["a", "b"], "y", trees=1)
    elif module is B:
        B.boost(lumped, ["a", "b"], "y", B.Boosting(n_estimators=1, max_depth=1))
    else:
        L.train_net(lumped, ["a", "b"], "k", (2,), max_iter=1)
        L.train_rbf_regressor(lumped, ["a", "b"], "y", gamma=0.1, n_components=2, c=1.0)
    assert seen and all(seen)


def test_estimators_are_fitted_on_all_cores(spark, lumped, monkeypatch):
    """MLlib's boosting reads the rows once per level and round."""
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: seen.append(even(df, spark)) or fit(self, df, *a))
    pipe = L.make_pipeline([L.assembler(["a", "b"]), L.GBTRegressor(labelCol="y", maxIter=1)])
    before = held(spark)
    assert L.fit_predict_submit(lumped, lumped, pipe, "id").count() == 800
    L.train_gbt_classifier(lumped, ["a", "b"], "k", {"n_estimators": 1})
    assert seen == [True, True] and held(spark) == before


def test_dealing_changes_no_tree(spark, lumped, monkeypatch):
    keyed = lumped.withColumn("id", F.xxhash64("a", "b", "k"))
    score = lambda: sorted(tuple(r) for r in R.train_forest(keyed, ["a", "b"], "y", trees=3, id_col="id", node_rows=50)
                           .transform(keyed).select("id", F.round("prediction", 9)).collect())
    dealt = score()
    monkeypatch.setattr(frames, "DEAL_ROWS", 10**9)
    assert score() == dealt
