"""Evaluation metrics (K1-K8) as plain aggregates over (label, score).

Every metric is a partial aggregate (map-side combine, one row of state per
task).  The ranking metrics (ROC, AUC) first reduce rows to one row per
distinct score, so a heavily repeated score is a single row and never a hot
task; running counts over the score order come from the bucketed prefix sum
in :mod:`tabkit.functions.prefix` (no unpartitioned window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize, with_scalars
from tabkit.functions.prefix import ordered_prefix_sums
from tabkit.functions.scalar import clip_col

# Fixed value: probability clipping of the binary cross-entropy.
LOG_LOSS_EPSILON = 1e-7


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _d(col) -> Column:
    return _c(col).cast("double")


def mae_col(y, p) -> Column:
    return F.avg(F.abs(_d(y) - _d(p)))


def mse_col(y, p) -> Column:
    return F.avg(F.pow(_d(y) - _d(p), 2))


def rmse_col(y, p) -> Column:
    return F.sqrt(mse_col(y, p))


def accuracy_col(y, p) -> Column:
    return F.avg((_d(y) == _d(p)).cast("double"))


def mae(df: DataFrame, y: str, p: str) -> DataFrame:
    """K1: mean absolute error, one row ``(mae)``."""
    return df.agg(mae_col(y, p).alias("mae"))


def mse(df: DataFrame, y: str, p: str) -> DataFrame:
    """K2: mean squared error."""
    return df.agg(mse_col(y, p).alias("mse"))


def rmse(df: DataFrame, y: str, p: str) -> DataFrame:
    """K3: root mean squared error."""
    return df.agg(rmse_col(y, p).alias("rmse"))


def regression_metrics(df: DataFrame, y: str, p: str, group_cols: list[str] | None = None) -> DataFrame:
    """K1-K3 fused into one aggregate (optionally per group, e.g. per fold)."""
    aggs = [mae_col(y, p).alias("mae"), mse_col(y, p).alias("mse"), rmse_col(y, p).alias("rmse")]
    return df.groupBy(*(group_cols or [])).agg(*aggs)


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """K4: share of rows whose prediction equals the label."""
    return df.agg(accuracy_col(y, p).alias("accuracy"))


def _score_counts(df: DataFrame, y: str, score: str, group_cols: list[str]) -> DataFrame:
    """One row per (group, distinct score): positives and negatives there."""
    yy = _d(y)
    return (df.where(_c(score).isNotNull() & yy.isNotNull())
            .groupBy(*group_cols, _d(score).alias("score"))
            .agg(F.sum(F.when(yy == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
                 F.sum(F.when(yy == 1, 0).otherwise(1)).cast("bigint").alias("neg")))


def roc_curve(df: DataFrame, y: str, score: str, thin: bool = False) -> DataFrame:
    """K5: ROC points ``(threshold, fpr, tpr)``, one per distinct score in
    decreasing order, plus the start point (0, 0) whose threshold is null
    (it lies above every score).

    ``thin`` drops points collinear with both neighbours in the sense of a
    repeated step: a point is dropped when its (negatives, positives) step
    equals the step of the next lower score; the first and last points are
    kept.  The neighbour comes from an equi-join on the dense rank of the
    score, not from a global window.
    """
    # one row per distinct score, read by the bucketing, the running sums
    # and the totals: computed once
    counts = materialize(_score_counts(df, y, score, []).withColumn("one", F.lit(1).cast("bigint")))
    pref = ordered_prefix_sums(counts, "score", ["pos", "neg", "one"], descending=True)
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.count(F.lit(1)).alias("K"))
    pts = pref.transform(with_scalars(tot)).select(
        "score", "pos", "neg", F.col("cum_one").alias("rank"), "K",
        F.try_divide(F.col("cum_neg").cast("double"), F.col("N").cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("tpr"))
    if thin:
        nxt = pts.select((F.col("rank") - 1).alias("rank"), F.col("pos").alias("n_pos"),
                         F.col("neg").alias("n_neg"))
        pts = (pts.join(nxt, "rank", "left")
               .where((F.col("rank") == 1) | F.col("n_pos").isNull()
                      | (F.col("pos") != F.col("n_pos")) | (F.col("neg") != F.col("n_neg"))))
    start = tot.select(F.lit(None).cast("double").alias("threshold"),
                       F.when(F.col("N") > 0, F.lit(0.0)).alias("fpr"),
                       F.when(F.col("P") > 0, F.lit(0.0)).alias("tpr"))
    return start.unionByName(pts.select(F.col("score").alias("threshold"), "fpr", "tpr"))


def roc_auc(df: DataFrame, y: str, score: str, group_cols: list[str] | None = None) -> DataFrame:
    """K6: tie-aware area under the ROC curve (trapezoids over distinct
    scores = Mann-Whitney with half credit for ties).  Any real score works
    (e.g. raw regression output).  A single-class input gives null.

    AUC = sum_s neg_s * (positives above s + pos_s / 2) / (P * N).
    The "positives above s" term is a running sum over descending scores.
    With ``group_cols`` (e.g. fold) the running sums are per group.
    """
    group_cols = group_cols or []
    counts = materialize(_score_counts(df, y, score, group_cols))
    if group_cols:
        from tabkit.functions.prefix import add_buckets, prefix_sums_long
        bucketed, (bcol,) = add_buckets(counts, ["score"])
        pref = prefix_sums_long(bucketed, group_cols, "score", ["pos"], bcol, descending=True).drop(bcol)
    else:
        pref = ordered_prefix_sums(counts, "score", ["pos"], descending=True)
    above = F.col("cum_pos") - F.col("pos")
    per = pref.groupBy(*group_cols).agg(
        F.sum(F.col("neg").cast("double") * (above.cast("double") + F.col("pos") / 2.0)).alias("u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    den = F.col("P").cast("double") * F.col("N").cast("double")
    return per.select(*group_cols, F.when(den > 0, F.col("u") / den).alias("auc"))


def precision_recall(df: DataFrame, y: str, score: str, t: float = 0.5) -> DataFrame:
    """K7: precision and recall of ``score > t``; 0/0 gives 0."""
    pred = _d(score) > F.lit(t)
    pos = _d(y) == 1
    agg = df.agg(F.count_if(pred & pos).alias("tp"), F.count_if(pred & ~pos).alias("fp"),
                 F.count_if(~pred & pos).alias("fn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0,
                  F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    rec = F.when(F.col("tp") + F.col("fn") > 0,
                 F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    return agg.select(prec.alias("precision"), rec.alias("recall"))


def log_loss_col(y, p, weight=None, eps: float = LOG_LOSS_EPSILON) -> Column:
    """Binary cross-entropy with probabilities clipped to [eps, 1 - eps]; a
    weight multiplies each row's loss and the mean is over rows (the
    convention of a per-sample-weighted training loss).  Rows without label
    or probability have no loss and are left out of the mean."""
    pp = clip_col(_d(p), eps, 1.0 - eps)
    yy = _d(y)
    loss = -(yy * F.log(pp) + (F.lit(1.0) - yy) * F.log(F.lit(1.0) - pp))
    if weight is not None:
        loss = loss * _d(weight)
    return F.avg(loss)


def log_loss(df: DataFrame, y: str, p: str, weight: str | None = None,
             eps: float = LOG_LOSS_EPSILON) -> DataFrame:
    """K8: mean binary cross-entropy (optionally class-weighted)."""
    return df.agg(log_loss_col(y, p, weight, eps).alias("log_loss"))


def classification_report(df: DataFrame, y: str, score: str, t: float = 0.5) -> DataFrame:
    """K4 + K6 + K7 + K8 in two passes (one aggregate, one AUC)."""
    pred = (_d(score) > F.lit(t)).cast("double")
    first = df.agg(accuracy_col(y, pred).alias("accuracy"), log_loss_col(y, score).alias("log_loss"))
    return (first.transform(with_scalars(roc_auc(df, y, score)))
            .transform(with_scalars(precision_recall(df, y, score, t))))
