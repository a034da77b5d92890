"""Registered queries: evaluation metrics (K1-K8).

Regression metrics score a simple price model on lineitem; classification
metrics score ``labels`` (quality) against a document-length score built
from ``documents`` (many tied scores: the cap and repeated lengths).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators import metrics as K
from tabkit.plans.common import SEED, r, t
from tabkit.plans.registry import query

# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------
# regression: predict the extended price from quantity x the part's retail price
_LI_PRED_SQL = """
  SELECT l_orderkey, l_linenumber, l_extendedprice AS y, l_quantity * p_retailprice AS p
  FROM lineitem JOIN part ON l_partkey = p_partkey"""

# classification: quality label against a capped document length score
_DOC_SCORE_SQL = """
  SELECT l.doc_id, l.quality AS y, l.toxic, least(d.n_chars, 10000) / CAST(10000 AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def _li_pred(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                         "l_extendedprice")
    part = t(spark, sf, "part").select("p_partkey", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey)
    return j.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("y"),
                    (F.col("l_quantity") * F.col("p_retailprice")).alias("p"))


# The score is a stand-in for a probability, which accuracy, log loss and the like need
# in 0..1, and its cap makes one large group of ties, as rounded scores have.
# roc_auc_uncapped tells the documents above the cap apart.
def _doc_score(spark, sf):
    lab = t(spark, sf, "labels")
    doc = t(spark, sf, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), "toxic",
        (F.least(F.col("n_chars"), F.lit(10000)) / F.lit(10000.0)).alias("score"))


@query("mae", "K1", sql=f"SELECT round(avg(abs(y - p)), 6) AS mae FROM ({_LI_PRED_SQL})")
def q_mae(spark, sf):
    return K.mae(_li_pred(spark, sf), "y", "p").select(r("mae").alias("mae"))


@query("mse", "K2", sql=f"SELECT round(avg((y - p) * (y - p)), 4) AS mse FROM ({_LI_PRED_SQL})")
def q_mse(spark, sf):
    return K.mse(_li_pred(spark, sf), "y", "p").select(r("mse", 4).alias("mse"))


@query("rmse_by_fold", "K3,K1,K2,R3", sql=f"""
SELECT fold, round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 4) AS mse,
       round(sqrt(avg((y - p) * (y - p))), 6) AS rmse
FROM (SELECT *, CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-{SEED}'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold
      FROM ({_LI_PRED_SQL}))
GROUP BY fold""")
def q_rmse_by_fold(spark, sf):
    from tabkit.operators.split import k_fold
    m = K.regression_metrics(k_fold(_li_pred(spark, sf), "l_orderkey", 5, SEED), "y", "p", ["fold"])
    return m.select("fold", r("mae").alias("mae"), r("mse", 4).alias("mse"), r("rmse").alias("rmse"))


@query("accuracy", "K4,P11", sql=f"""
SELECT round(avg(CASE WHEN y = CAST(score > 0.5 AS INTEGER) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM ({_DOC_SCORE_SQL})""")
def q_accuracy(spark, sf):
    from tabkit.operators.columns import threshold
    d = threshold(_doc_score(spark, sf), "score", 0.5, "int", out_col="pred")
    return K.accuracy(d, "y", "pred").select(r("accuracy").alias("accuracy"))


_ROC_SQL = f"""
WITH s AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM ({_DOC_SCORE_SQL}) GROUP BY score),
c AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn,
             row_number() OVER (ORDER BY score DESC) AS rk,
             lead(pos) OVER (ORDER BY score DESC) AS n_pos, lead(neg) OVER (ORDER BY score DESC) AS n_neg
      FROM s),
tot AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s)
"""


@query("roc_curve", "K5", sql=_ROC_SQL + """
SELECT NULL::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT score, round(cn / n, 6), round(cp / p, 6) FROM c, tot""")
def q_roc_curve(spark, sf):
    roc = K.roc_curve(_doc_score(spark, sf), "y", "score")
    return roc.select("threshold", r("fpr").alias("fpr"), r("tpr").alias("tpr"))


@query("roc_curve_thin", "K5", sql=_ROC_SQL + """
SELECT NULL::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT score, round(cn / n, 6), round(cp / p, 6) FROM c, tot
WHERE rk = 1 OR n_pos IS NULL OR pos <> n_pos OR neg <> n_neg""")
def q_roc_curve_thin(spark, sf):
    roc = K.roc_curve(_doc_score(spark, sf), "y", "score", thin=True)
    return roc.select("threshold", r("fpr").alias("fpr"), r("tpr").alias("tpr"))


@query("roc_auc", "K6", bench=True, sql=f"""
WITH s AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM ({_DOC_SCORE_SQL}) GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) - pos AS above FROM s)
SELECT round(sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
def q_roc_auc(spark, sf):
    return K.roc_auc(_doc_score(spark, sf), "y", "score").select(r("auc").alias("auc"))


@query("roc_auc_uncapped", "K6", sql="""
WITH s AS (SELECT n_chars AS score, sum(quality) AS pos, sum(1 - quality) AS neg FROM labels JOIN documents USING (doc_id)
           GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) - pos AS above FROM s)
SELECT round(sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
def q_roc_auc_uncapped(spark, sf):
    doc = t(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    d = t(spark, sf, "labels").select("doc_id", F.col("quality").alias("y")).join(doc, "doc_id")
    return K.roc_auc(d, "y", "score").select(r("auc").alias("auc"))


@query("roc_auc_by_toxic", "K6", sql=f"""
WITH s AS (SELECT toxic, score, sum(y) AS pos, sum(1 - y) AS neg FROM ({_DOC_SCORE_SQL}) GROUP BY toxic, score),
c AS (SELECT *, sum(pos) OVER (PARTITION BY toxic ORDER BY score DESC) - pos AS above FROM s)
SELECT toxic, round(sum(neg * (above + pos / 2.0)) / nullif(sum(pos) * sum(neg), 0), 6) AS auc
FROM c GROUP BY toxic""")
def q_roc_auc_by_toxic(spark, sf):
    return K.roc_auc(_doc_score(spark, sf), "y", "score", ["toxic"]).select("toxic", r("auc").alias("auc"))


@query("precision_recall", "K7", sql=f"""
WITH c AS (SELECT count(*) FILTER (WHERE score > 0.5 AND y = 1) AS tp,
                  count(*) FILTER (WHERE score > 0.5 AND y <> 1) AS fp,
                  count(*) FILTER (WHERE score <= 0.5 AND y = 1) AS fn FROM ({_DOC_SCORE_SQL}))
SELECT round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall FROM c""")
def q_precision_recall(spark, sf):
    pr = K.precision_recall(_doc_score(spark, sf), "y", "score", 0.5)
    return pr.select(r("precision").alias("precision"), r("recall").alias("recall"))


@query("log_loss", "K8,R6", sql=f"""
WITH d AS (SELECT *, greatest(least(score, 1 - 1e-7), 1e-7) AS pc FROM ({_DOC_SCORE_SQL})),
w AS (SELECT CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) / count(*) FILTER (WHERE y = 1) AS w1 FROM d)
SELECT round(avg(-(y * ln(pc) + (1 - y) * ln(1 - pc))), 6) AS log_loss,
       round(avg(CASE WHEN y = 1 THEN w1 ELSE 1.0 END * -(y * ln(pc) + (1 - y) * ln(1 - pc))), 6) AS weighted_log_loss
FROM d, w""")
def q_log_loss(spark, sf):
    from tabkit.operators.split import class_weights
    d = class_weights(_doc_score(spark, sf), "y")
    return d.agg(r(K.log_loss_col("y", "score")).alias("log_loss"),
                 r(K.log_loss_col("y", "score", "weight")).alias("weighted_log_loss"))
