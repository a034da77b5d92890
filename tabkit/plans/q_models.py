"""Registered queries: model training, search, stacking and scoring
(L1-L19, R5).

Tree ensembles and nets have no SQL form: those queries get the rows-only check
and their invariants are asserted in ``tests/test_model_invariants.py``.  Whatever
about them is exact (ids scored once, fold counts, one-feature ridge and lasso,
the fixed network) has a query with an oracle.

Training sets (all derived from the driver tables, whole tables):

* price:   lineitem x part -> l_extendedprice (regression)
* orders:  orders x customer x per-order lineitem aggregates -> fulfilled (binary)
* quality: labels x documents text statistics -> quality (binary)

Queries run the operators' defaults, which are the original settings, or the
original settings themselves (``CV``): the search has all its 25 draws and 5
folds, the study all its 100 splits.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.functions.frames import with_scalars
from tabkit.operators import metrics as K
from tabkit.operators import models as L
from tabkit.operators.split import assign_split, class_weights
from tabkit.plans.common import SEED, TEST_CUT, sql_bucket, t
from tabkit.plans.registry import query

# The original report's boosting: 100 rounds of depth 3 on all rows, 5 folds.
CV = {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0}

PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
ORDER_FEATURES = ["o_totalprice", "priority", "c_acctbal", "n_lines", "avg_discount", "avg_quantity"]
QUALITY_FEATURES = ["n_chars", "n_lines", "n_words", "digit_share", "upper_share", "is_en"]


def _price(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                         "l_discount", "l_tax", "l_extendedprice")
    p = t(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    d = li.join(p, li.l_partkey == p.p_partkey)
    d = d.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), *PRICE_FEATURES,
                 "l_extendedprice")
    return assign_split(d, "id", 0.25, SEED)


def _orders(spark, sf):
    from tabkit.operators.encode import encode_ordered
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                      "o_orderstatus")
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    li = (t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
          .agg(F.count(F.lit(1)).cast("double").alias("n_lines"), F.avg("l_discount").alias("avg_discount"),
               F.avg("l_quantity").alias("avg_quantity")))
    d = o.join(c, "o_custkey").join(li, "o_orderkey", "left")
    d = encode_ordered(d, {"o_orderpriority": ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]})
    d = d.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").cast("double").alias("priority"),
                 "o_totalprice", "c_acctbal", F.coalesce("n_lines", F.lit(0.0)).alias("n_lines"),
                 F.coalesce("avg_discount", F.lit(0.0)).alias("avg_discount"),
                 F.coalesce("avg_quantity", F.lit(0.0)).alias("avg_quantity"),
                 (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    return assign_split(d, "id", 0.25, SEED)


def _quality(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id", "quality")
    doc = t(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    d = lab.join(doc, "doc_id")
    n = F.greatest(F.length("text"), F.lit(1)).cast("double")
    d = d.select(F.col("doc_id").alias("id"), F.col("n_chars").cast("double").alias("n_chars"),
                 F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
                 F.size(F.split(F.trim("text"), r"\s+")).cast("double").alias("n_words"),
                 (F.length(F.regexp_replace("text", "[^0-9]", "")) / n).alias("digit_share"),
                 (F.length(F.regexp_replace("text", "[^A-Z]", "")) / n).alias("upper_share"),
                 (F.col("lang") == "en").cast("double").alias("is_en"),
                 F.col("quality").cast("double").alias("label"))
    return assign_split(d, "id", 0.2, SEED)


def _train(d):
    return d.where(F.col("split") == "train")


def _test(d):
    return d.where(F.col("split") == "test")


@query("gbt_regressor", "L1,L18")
def q_gbt_regressor(spark, sf):
    d = _price(spark, sf)
    m = L.train_boosted_regressor(_train(d), PRICE_FEATURES, "l_extendedprice", id_col="id")
    return m.transform(_test(d)).select("id", "l_extendedprice", "prediction")


@query("rf_regressor", "L2")
def q_rf_regressor(spark, sf):
    d = _price(spark, sf)
    m = L.train_rf_regressor(_train(d), PRICE_FEATURES, "l_extendedprice", id_col="id")
    return m.transform(_test(d)).select("id", "l_extendedprice", "prediction")


@query("gbt_classifier_auc", "L3,K6")
def q_gbt_classifier_auc(spark, sf):
    d = _orders(spark, sf)
    m = L.train_gbt_classifier(_train(d), ORDER_FEATURES, "label")
    scored = L.positive_probability(m.transform(_test(d)))
    return K.roc_auc(scored, "label", "p1")


@query("rf_classifier", "L4,E9,K4")
def q_rf_classifier(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority", "o_totalprice",
                                      (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    d = assign_split(o, "id", 0.25, SEED)
    m = L.train_rf_classifier(_train(d), ["o_orderpriority"], ["o_totalprice"], "label", id_col="id")
    return K.accuracy(m.transform(_test(d)), "label", "prediction")


@query("ridge_cv", "L5,R3", bench=True)
def q_ridge_cv(spark, sf):
    d = _price(spark, sf)
    _, scores = L.train_ridge_loo(_train(d), PRICE_FEATURES, "l_extendedprice")
    return scores


@query("lasso_cv", "L6,R3")
def q_lasso_cv(spark, sf):
    d = _price(spark, sf)
    _, scores = L.train_lasso_cv(_train(d), PRICE_FEATURES, "l_extendedprice", "id")
    return scores


@query("stacking_auc", "L7,R5,L5,L6,V4,K6", bench=True)
def q_stacking_auc(spark, sf):
    d = _quality(spark, sf)
    feats = QUALITY_FEATURES
    bases = {
        "ridge": L.spark_learner(lambda tr: L.train_ridge_loo(tr, feats, "label")[0]),
        "lasso": L.spark_learner(lambda tr: L.train_lasso_cv(tr, feats, "label", "id")[0]),
        "knn": L.knn_learner("id", feats, "label", k=20),
    }
    stack = L.train_stack(_train(d), bases, "label", "id")
    return K.roc_auc(stack.transform(_test(d)), "label", "prediction")


@query("rbf_regressor_auc", "L8,N2,K6")
def q_rbf_regressor_auc(spark, sf):
    d = _quality(spark, sf)
    m = L.train_rbf_regressor(_train(d), QUALITY_FEATURES, "label", gamma=0.01)
    return K.roc_auc(m.transform(_test(d)), "label", "prediction")


@query("random_search", "L9,L1,R3")
def q_random_search(spark, sf):
    d = _price(spark, sf)
    _, draws = L.random_search(_train(d), PRICE_FEATURES, "l_extendedprice", "id")
    return draws


@query("feature_importance", "L10,T1")
def q_feature_importance(spark, sf):
    d = _price(spark, sf)
    m = L.train_boosted_regressor(_train(d), PRICE_FEATURES, "l_extendedprice", id_col="id")
    return L.feature_importance(m, PRICE_FEATURES)


@query("importance_study", "L11,R4,A16")
def q_importance_study(spark, sf):
    d = _orders(spark, sf)
    long = L.importance_study(d, ORDER_FEATURES, "label", "id", frac=0.4)
    return L.importance_summary(long)


@query("staged_error", "L12,L3", bench=True)
def q_staged_error(spark, sf):
    d = _orders(spark, sf)
    return L.staged_curve(d, ORDER_FEATURES, "label", F.col("split") == "train", F.col("split") == "test", id_col="id")


@query("cv_report", "L13,R3,K4,K6")
def q_cv_report(spark, sf):
    d = _orders(spark, sf)
    return L.cv_report(d, ORDER_FEATURES, "label", "id", params=CV)


# A fixed 4-3-1 network with a sigmoid output (values chosen for this query) on
# standardised lineitem columns.
_NET_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_NET_MEAN = [25.5, 38000.0, 0.05, 0.04]
_NET_STD = [14.4, 23000.0, 0.032, 0.026]
_NET_W1 = [[0.5, -0.25, 0.1], [0.3, 0.8, -0.6], [-0.7, 0.2, 0.4], [0.05, -0.3, 0.9]]
_NET_B1 = [0.1, -0.2, 0.05]
_NET_W2 = [[1.2], [-0.7], [0.45]]
_NET_B2 = [0.3]


def _net_sql() -> str:
    z = [f"(({c} - {m}) / {s})" for c, m, s in zip(_NET_FEATURES, _NET_MEAN, _NET_STD)]
    hidden = []
    for j in range(3):
        terms = " + ".join(f"{z[i]} * ({_NET_W1[i][j]})" for i in range(4))
        hidden.append(f"greatest({terms} + ({_NET_B1[j]}), 0.0)")
    out = " + ".join(f"{h} * ({_NET_W2[j][0]})" for j, h in enumerate(hidden))
    return f"1.0 / (1.0 + exp(-({out} + ({_NET_B2[0]}))))"


@query("score_dense", "L14", sql=f"""
SELECT l_orderkey, l_linenumber, round({_net_sql()}, 6) AS score FROM lineitem""")
def q_score_dense(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_NET_FEATURES)
    out = L.score_dense(li, _NET_FEATURES, [(_NET_W1, _NET_B1), (_NET_W2, _NET_B2)], _NET_MEAN, _NET_STD,
                        final="sigmoid")
    return out.select("l_orderkey", "l_linenumber", F.round("score", 6).alias("score"))


@query("early_stopping", "L15")
def q_early_stopping(spark, sf):
    """The watched loss by round, up to the round at which patience ran out,
    and the loss of the model that was kept, scored anew on the watched rows."""
    d = _orders(spark, sf)
    watch = F.col("split") == "test"
    m, curve = L.train_with_patience(d, ORDER_FEATURES, "label", watch, {"n_estimators": 200, "learning_rate": 0.3},
                                     id_col="id", classifier=True)
    kept = m.transform(_test(d)).agg(K.log_loss_col("label", "p1").alias("kept_loss"))
    return curve.transform(with_scalars(kept)).withColumn("kept_rounds", F.lit(len(m.trees)))


@query("mlp_classifier", "L16,R6,N2,K4,K8")
def q_mlp_classifier(spark, sf):
    from tabkit.operators.scale import apply_standard
    d = _orders(spark, sf)
    train = class_weights(_train(d), "label")
    m, std = L.train_mlp_classifier(train, ORDER_FEATURES, "label", "id", weight_col="weight")
    scored = m.transform(apply_standard(_test(d), std))
    return scored.agg(K.accuracy_col("label", "prediction").alias("accuracy"),
                      K.log_loss_col("label", "p1").alias("log_loss"))


@query("fit_predict_submit", "L17,L18,S4,M3")
def q_fit_predict_submit(spark, sf):
    from pyspark.ml.feature import Imputer
    from pyspark.ml.regression import GBTRegressor
    from tabkit.sources.io import scratch_dir
    d = _price(spark, sf)
    pipe = L.make_pipeline([Imputer(inputCols=PRICE_FEATURES, outputCols=PRICE_FEATURES, strategy="mean"),
                            L.assembler(PRICE_FEATURES),
                            GBTRegressor(featuresCol="features", labelCol="l_extendedprice", seed=SEED,
                                         **L.GBT_REGRESSOR_DEFAULTS)])
    return L.fit_predict_submit(_train(d), _test(d), pipe, "id", scratch_dir(spark, "l18-submission"))


@query("select_best", "L19,L12")
def q_select_best(spark, sf):
    """Three candidates; the one with the least validation log loss is saved,
    read back and scored."""
    from pyspark.ml import PipelineModel
    from tabkit.sources.io import scratch_dir
    d = _orders(spark, sf).cache()

    def loss(m):
        return L.positive_probability(m.transform(_test(d))).agg(K.log_loss_col("label", "p1")).first()[0]

    models = {f"depth_{k}": L.train_gbt_classifier(_train(d), ORDER_FEATURES, "label", {"max_depth": k})
              for k in (1, 3, 5)}
    path = scratch_dir(spark, "l19-model")
    best, _, values = L.select_best(models, loss, "min", path)
    saved = loss(PipelineModel.load(path))
    return spark.createDataFrame([(name, v, name == best, abs(saved - v) < 1e-12) for name, v in values.items()],
                                 "run_id string, valid_loss double, best boolean, is_saved_model boolean")


_PRICE_SQL = """FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""


@query("ridge_one_feature", "L5", sql=f"""
WITH m AS (SELECT covar_pop(l_quantity, l_extendedprice) * count(*) AS xy, var_pop(l_quantity) * count(*) AS xx {_PRICE_SQL})
SELECT a AS alpha, round(xy / (xx + a), 6) AS slope FROM m, (SELECT unnest([0.1, 100.0, 10000000.0]::DOUBLE[]) AS a)""")
def q_ridge_one_feature(spark, sf):
    m = L.fold_moments(_price(spark, sf), ["l_quantity"], "l_extendedprice", F.lit(0))[0]
    rows = [(a, round(float(L.solve_ridge(m, a)[0]), 6)) for a in (0.1, 100.0, 1e7)]
    return spark.createDataFrame(rows, "alpha double, slope double")


@query("ridge_leave_one_out", "L5", sql=f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y {_PRICE_SQL}),
m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS xy, var_pop(x) * count(*) AS xx FROM d),
a AS (SELECT unnest([0.1, 1000.0, 10000000.0]::DOUBLE[]) AS alpha)
SELECT alpha, round(avg(pow((y - my - xy / (xx + alpha) * (x - mx)) / (1 - 1.0 / n - pow(x - mx, 2) / (xx + alpha)), 2))
                    / 1e6, 4) AS loo_mse
FROM d, m, a GROUP BY alpha""")
def q_ridge_leave_one_out(spark, sf):
    """In millions of squared units."""
    _, scores = L.train_ridge_loo(_price(spark, sf), ["l_quantity"], "l_extendedprice", [0.1, 1000.0, 1e7])
    return scores.select("alpha", F.round(F.col("loo_mse") / 1e6, 4).alias("loo_mse"))


@query("lasso_one_feature", "L6", sql=f"""
WITH m AS (SELECT covar_pop(l_quantity, l_extendedprice) AS xy, var_pop(l_quantity) AS xx {_PRICE_SQL})
SELECT a AS alpha, round(sign(xy) * greatest(abs(xy) - a, 0.0) / xx, 6) AS slope
FROM m, (SELECT unnest([0.1, 1000.0, 100000000.0]::DOUBLE[]) AS a)""")
def q_lasso_one_feature(spark, sf):
    m = L.fold_moments(_price(spark, sf), ["l_quantity"], "l_extendedprice", F.lit(0))[0]
    rows = [(a, round(float(L.solve_lasso(m, a)[0]) + 0.0, 6)) for a in (0.1, 1000.0, 1e8)]
    return spark.createDataFrame(rows, "alpha double, slope double")


@query("ridge_predictions", "L5", sql=f"""
WITH d AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity AS x, l_extendedprice AS y {_PRICE_SQL}),
m AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS xy, var_pop(x) * count(*) AS xx FROM d)
SELECT id, round(my + xy / (xx + 10.0) * (x - mx), 4) AS prediction FROM d, m""")
def q_ridge_predictions(spark, sf):
    d = _price(spark, sf)
    model, _ = L.train_ridge_cv(d, ["l_quantity"], "l_extendedprice", "id", alphas=[10.0])
    return model.transform(d).select("id", F.round("prediction", 4).alias("prediction"))


@query("oof_ids", "R5", sql="""
SELECT doc_id AS id, 1::BIGINT AS n_predictions, 0::BIGINT AS n_missing FROM labels JOIN documents USING (doc_id)""")
def q_oof_ids(spark, sf):
    """Every row gets exactly one out-of-fold prediction."""
    learner = L.spark_learner(lambda tr: L.train_ridge_cv(tr, QUALITY_FEATURES, "label", "id")[0])
    oof = L.oof_predict(_quality(spark, sf), learner, "id")
    return oof.groupBy("id").agg(F.count("*").alias("n_predictions"),
                                 F.count_if(F.col("prediction").isNull()).alias("n_missing"))


@query("submission_ids", "L18,S4", sql=f"""
SELECT l_orderkey * 8 + l_linenumber AS id {_PRICE_SQL}
WHERE {sql_bucket('l_orderkey * 8 + l_linenumber')} < {TEST_CUT}""")
def q_submission_ids(spark, sf):
    """Ids of the written submission: those of the test rows, once each."""
    from pyspark.ml.regression import GBTRegressor
    from tabkit.sources.io import read_table, scratch_dir
    d, path = _price(spark, sf), scratch_dir(spark, "l18-ids")
    pipe = L.make_pipeline([L.assembler(PRICE_FEATURES), GBTRegressor(labelCol="l_extendedprice", seed=SEED, **L.GBT_REGRESSOR_DEFAULTS)])
    L.fit_predict_submit(_train(d), _test(d), pipe, "id", path)
    return read_table(spark, path, "id long, prediction double").select("id")


@query("cv_fold_counts", "R3", sql=f"""
SELECT fold, side, count(*) AS n FROM (
  SELECT f AS fold, CASE WHEN {sql_bucket('o_orderkey')} % 5 = f THEN 'valid' ELSE 'train' END AS side
  FROM orders JOIN customer ON o_custkey = c_custkey, (SELECT unnest([0, 1, 2, 3, 4])::INT AS f)) GROUP BY ALL""")
def q_cv_fold_counts(spark, sf):
    """Rows on each side of each fold of the CV report."""
    rows = L.k_fold(_orders(spark, sf).select("id"), "id", 5, SEED, "row_fold")
    sides = rows.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(4))))
    side = F.when(F.col("row_fold") == F.col("fold"), "valid").otherwise("train")
    return sides.groupBy("fold", side.alias("side")).agg(F.count("*").alias("n"))


@query("split_null_ids", "R1,R3", sql=f"""
WITH d AS (SELECT l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_orderkey END AS k FROM lineitem),
b AS (SELECT *, coalesce({sql_bucket('k')}, 4294967295) AS h FROM d)
SELECT CASE WHEN h < {TEST_CUT} THEN 'test' ELSE 'train' END AS split, (h % 5)::INT AS fold, count(*) AS n,
       count(*) FILTER (k IS NULL) AS n_without_id FROM b GROUP BY ALL""")
def q_split_null_ids(spark, sf):
    """Rows without id take part in splits and folds."""
    d = t(spark, sf, "lineitem").select("l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_orderkey")).alias("k"))
    out = L.k_fold(assign_split(d, "k", 0.25, SEED), "k", 5, SEED)
    return out.groupBy("split", "fold").agg(F.count("*").alias("n"), F.count_if(F.col("k").isNull()).alias("n_without_id"))


@query("fold_metrics", "L13,K4,K6", sql="""
WITH d AS (
  SELECT o_orderkey % 3 AS fold, CASE WHEN o_orderkey % 2 = 0 THEN 'train' ELSE 'valid' END AS side,
         CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y, floor(o_totalprice / 5000) AS s FROM orders),
c AS (SELECT fold, side, s, count(*) AS n, sum(y) AS p FROM d GROUP BY ALL),
r AS (SELECT *, sum(n - p) OVER (PARTITION BY fold, side ORDER BY s) - (n - p) / 2 AS below FROM c),
auc AS (SELECT fold, side, sum(p * below) / (sum(p) * sum(n - p)) AS value FROM r GROUP BY fold, side)
SELECT fold::INT AS fold, side, 'auc' AS metric, round(value, 6) AS value FROM auc UNION ALL
SELECT fold::INT, side, 'accuracy', round(avg(((s > 30)::INT = y)::INT), 6) FROM d GROUP BY fold, side""")
def q_fold_metrics(spark, sf):
    """The report's metrics from scores that SQL can make."""
    o = t(spark, sf, "orders")
    s = F.floor(F.col("o_totalprice") / 5000).cast("double")
    rows = o.select((F.col("o_orderkey") % 3).cast("int").alias("fold"),
                    F.when(F.col("o_orderkey") % 2 == 0, "train").otherwise("valid").alias("side"),
                    (F.col("o_orderstatus") == "F").cast("double").alias("label"), s.alias("p1"),
                    (s > 30).cast("double").alias("prediction"))
    return L.fold_metrics(rows, "label").withColumn("value", F.round("value", 6))
