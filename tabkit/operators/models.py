"""Model training, search, stacking and scoring.

Every fit is a distributed job: executors compute tree statistics, gradients or
moments over their partitions and only fitted parameters reach the driver.
Second-order and classic boosting, searches over many models, staged errors
and early stopping run on the binned blocks of :mod:`tabkit.operators.boosting`;
forests on those of :mod:`tabkit.operators.forests`; kernel regression and the
net on gradients summed over blocks (:mod:`tabkit.operators.lbfgs`); ridge and
lasso on moments per fold; the rest is ``pyspark.ml``.  Splits and folds are the deterministic
hash columns of :mod:`tabkit.operators.split`, so a refit after executor loss
sees identical folds; the hash is salted per purpose (``cv`` for an estimator's
internal CV, ``oof`` for out-of-fold stacking) so nested splits are independent.

Fidelity notes: ``train_gbt_regressor`` and ``train_gbt_classifier`` are the
first-order Spark ML learners, kept for pipelines that are saved and read;
the RBF kernel is approximated by random Fourier features.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.frames import dealt_rows, materialize
from tabkit.functions.scalar import HASH_SPACE, hash_bucket
from tabkit.operators.blocks import Bins, pack_blocks
from tabkit.operators.boosting import (LOCAL_ROWS, LOGISTIC, SQUARED, BoostedModel, boost, boost_many, boosting_spec,
                                       tree_importances)
from tabkit.operators.encode import OneHotParams, apply_one_hot, fit_one_hot
from tabkit.operators.forests import NODE_ROWS, ForestModel, train_forest
from tabkit.operators.lbfgs import minimise, summed_loss
from tabkit.operators.split import k_fold

FEATURES = "features"
PREDICTION = "prediction"

# Hyperparameters the reference's scripts use.
GBT_REGRESSOR_DEFAULTS = {"stepSize": 0.01, "maxDepth": 3, "maxIter": 400, "subsamplingRate": 0.4,
                          "minInstancesPerNode": 1}
RF_TREES = 100
GBT_CLASSIFIER_DEFAULTS = {"maxIter": 200, "maxDepth": 3, "subsamplingRate": 0.25, "stepSize": 0.01}
STACK_FINAL_DEFAULTS = {"n_estimators": 25, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.5, "min_leaf": 25,
                        "max_features": 1, "newton": False}
XGB_DEFAULTS = {"n_estimators": 400, "max_depth": 3, "learning_rate": 0.01, "subsample": 0.4, "min_child_weight": 1}
GBC_DEFAULTS = {"n_estimators": 200, "max_depth": 3, "learning_rate": 0.01, "subsample": 0.25}
STUDY_DEFAULTS = {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1}
STAGED_DEFAULTS = {"n_estimators": 200, "max_depth": 5, "learning_rate": 0.1}
PATIENCE, MIN_DELTA = 20, 0.001
RIDGE_ALPHAS = (0.1, 1.0, 10.0)
LASSO_N_ALPHAS = 100
LASSO_EPS = 1e-3
MLP_HIDDEN = (32, 24, 16)
# search space of the randomized boosted-tree search (15 x 5 x 3 x 3 x 3 x 3 x 3 = 18,225 points)
SEARCH_GRID = {
    "n_estimators": [100, 200, 300, 400, 500, 600, 700, 800, 900, 1000, 1100, 1200, 1300, 1400, 1500],
    "max_depth": [3, 4, 5, 6, 7],
    "learning_rate": [0.01, 0.05, 0.1],
    "colsample_bytree": [0.6, 0.8, 1.0],
    "min_child_weight": [1, 3, 5],
    "gamma": [0, 0.1, 0.2],
    "subsample": [0.6, 0.8, 1.0],
}
SEARCH_ITER = 25
SEARCH_FOLDS = 5


# ---------------------------------------------------------------------------
# shared pieces
# ---------------------------------------------------------------------------
def assembler(features: Sequence[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    """P(class 1) from a probability vector, as a plain double column."""
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])


def gbt_params_from_boosting(params: Mapping) -> dict:
    """Translate boosted-tree hyperparameter names of the reference to
    ``GBTRegressor`` / ``GBTClassifier`` parameters."""
    out = {}
    for k, v in params.items():
        if k == "n_estimators":
            out["maxIter"] = int(v)
        elif k == "max_depth":
            out["maxDepth"] = int(v)
        elif k == "learning_rate":
            out["stepSize"] = float(v)
        elif k == "subsample":
            out["subsamplingRate"] = float(v)
        elif k == "min_child_weight":
            out["minInstancesPerNode"] = max(1, int(v))
        elif k == "gamma":
            out["minInfoGain"] = float(v)
        elif k == "colsample_bytree":
            out["featureSubsetStrategy"] = "all" if float(v) >= 1.0 else str(float(v))
        else:
            out[k] = v
    return out


def _fit(stages, df: DataFrame) -> PipelineModel:
    return _fit_dealt(Pipeline(stages=list(stages)), df)


def _fit_dealt(estimator, df: DataFrame):
    """A fitted estimator; its passes run over rows dealt evenly."""
    with dealt_rows(df) as rows:
        return estimator.fit(rows)


# ---------------------------------------------------------------------------
# L1-L4 trees
# ---------------------------------------------------------------------------
def train_gbt_regressor(df: DataFrame, features: Sequence[str], label: str,
                        params: Mapping | None = None, seed: int = 42) -> PipelineModel:
    """L1: gradient-boosted regression trees (defaults: lr 0.01, depth 3,
    400 rounds, subsample 0.4)."""
    p = dict(GBT_REGRESSOR_DEFAULTS, **gbt_params_from_boosting(params or {}))
    gbt = GBTRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **p)
    return _fit([assembler(features), gbt], df)


def train_boosted_regressor(df: DataFrame, features: Sequence[str], label: str, params: Mapping | None = None,
                            id_col: str | None = None, seed: int = 42, local_rows: int = LOCAL_ROWS) -> BoostedModel:
    """L1: second-order boosted regression trees under the original setting
    names (defaults: rate 0.01, depth 3, 400 rounds, 0.4 of the rows per tree,
    least Hessian sum 1)."""
    spec = boosting_spec({**XGB_DEFAULTS, **(params or {})}, seed=seed)
    return boost(df, features, label, spec, id_col, local_rows=local_rows)[0]


def train_rf_regressor(df: DataFrame, features: Sequence[str], label: str, num_trees: int = RF_TREES,
                       max_depth: int | None = None, seed: int = 42, max_features="all", min_leaf: int = 1,
                       id_col: str | None = None, node_rows: int = NODE_ROWS) -> ForestModel:
    """L2: random-forest regression; by default trees of unlimited depth whose
    splits consider all features.  ``max_features`` is ``all``, ``sqrt``,
    ``log2``, a number or a fraction."""
    return train_forest(df, features, label, None, num_trees, max_depth, max_features, min_leaf, seed, id_col, node_rows)


def train_gbt_classifier(df: DataFrame, features: Sequence[str], label: str,
                         params: Mapping | None = None, seed: int = 1,
                         weight_col: str | None = None) -> PipelineModel:
    """L3: gradient-boosted classification (defaults: 200 rounds, depth 3,
    subsample 0.25, lr 0.01); score with :func:`positive_probability`."""
    p = dict(GBT_CLASSIFIER_DEFAULTS, **gbt_params_from_boosting(params or {}))
    gbt = GBTClassifier(featuresCol=FEATURES, labelCol=label, seed=seed, **p)
    if weight_col:
        gbt.setWeightCol(weight_col)
    return _fit([assembler(features), gbt], df)


@dataclass(frozen=True)
class EncodedForest:
    """A forest behind a fitted one-hot encoding."""
    encoding: OneHotParams | None
    forest: ForestModel

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (of each class) and ``prediction``."""
        if self.encoding is None:
            return self.forest.transform(df)
        return self.forest.transform(apply_one_hot(df, self.encoding, "double", drop_source=False)).select(
            *(F.col(f"`{c}`") for c in df.columns), "probability", PREDICTION)


def train_rf_classifier(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str,
                        num_trees: int = RF_TREES, max_depth: int | None = None, seed: int = 1,
                        max_features="sqrt", min_leaf: int = 1, id_col: str | None = None,
                        node_rows: int = NODE_ROWS) -> EncodedForest:
    """L4: random-forest classification behind a fitted one-hot encoding that
    ignores levels unseen at fit time (E9); classes are the label's values."""
    encoding = fit_one_hot(df, list(categorical), prefixes={c: f"{c}__is" for c in categorical}) if categorical else None
    rows = apply_one_hot(df, encoding, "double", drop_source=False) if encoding else df
    features = [*(n for c in categorical for n in encoding.names[c]), *numeric]
    classes = [r[0] for r in df.select(label).where(F.col(f"`{label}`").isNotNull()).distinct().orderBy(label).limit(1001).collect()]
    if len(classes) > 1000:
        raise ValueError(f"more than 1000 classes in {label}")
    forest = train_forest(rows, features, label, classes, num_trees, max_depth, max_features, min_leaf, seed, id_col, node_rows)
    return EncodedForest(encoding, forest)


# ---------------------------------------------------------------------------
# L5 / L6 penalised linear models with CV-chosen penalty
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class LinearModel:
    """Fitted coefficients; scoring is one projection."""
    features: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float
    alpha: float

    def transform(self, df: DataFrame) -> DataFrame:
        score = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.coefficients):
            score = score + F.col(f"`{c}`").cast("double") * F.lit(float(w))
        return df.withColumn(PREDICTION, score)


@dataclass(frozen=True)
class Moments:
    """Row count, sums and products of (features..., label), around a point
    near their means (so that products do not cancel)."""
    n: float
    first: np.ndarray
    second: np.ndarray
    around: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.first + other.first, self.second + other.second, self.around)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.first - other.first, self.second - other.second, self.around)

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Means, and sums of products of features with each other and with
        the label, about the means."""
        s = self.second - np.outer(self.first, self.first) / self.n
        return self.around + self.first / self.n, s[:-1, :-1], s[:-1, -1]

    def squared_error(self, w: np.ndarray, intercept: float) -> float:
        """Sum of squared errors of a linear model over the rows."""
        v = np.append(-w, 1.0)
        bias = self.around @ v - intercept
        return float(v @ self.second @ v + 2 * bias * (v @ self.first) + self.n * bias * bias)


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: Column) -> dict[int, Moments]:
    """Moments per fold in one pass over the data (after one for the
    means).  Every task adds up blocks of rows in numpy and sends one row of
    ``(d + 2)^2`` numbers per fold; these are summed by place.  A missing or
    infinite value is an error."""
    names = [*features, label]
    rows = df.select(fold.cast("int").alias("fold"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    found = rows.agg(*[F.avg(f"c{i}") for i in range(len(names))]).first()
    around = np.array([v if v is not None and math.isfinite(v) else 0.0 for v in found])
    size = len(names) + 1

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([np.ones(batch.num_rows)] + [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            if not np.isfinite(x).all():
                raise ValueError(f"missing or infinite values among {names}")
            x[:, 1:] -= around
            for f in np.unique(folds):
                part = x[folds == f]
                sums[int(f)] = sums.get(int(f), 0.0) + part.T @ part
        out = sorted(sums.items())
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.int32()),
                                          pa.array([m.ravel() for _, m in out], pa.list_(pa.float64()))], names=["fold", "m"])

    parts = rows.mapInArrow(run, "fold int, m array<double>").select("fold", F.posexplode("m").alias("i", "v"))
    table: dict[int, np.ndarray] = {}
    for r in parts.groupBy("fold", "i").agg(F.sum("v").alias("v")).collect():
        table.setdefault(r.fold, np.zeros(size * size))[r.i] = r.v
    out = {}
    for f, flat in sorted(table.items()):
        m = flat.reshape(size, size)
        out[f] = Moments(m[0, 0], m[0, 1:], m[1:, 1:], around)
    return out


def solve_ridge(m: Moments, alpha: float) -> np.ndarray:
    """Coefficients that minimise the summed squared error plus
    ``alpha * |w|^2`` (the intercept is free)."""
    _, xx, xy = m.centred()
    return np.linalg.lstsq(xx + alpha * np.eye(len(xy)), xy, rcond=None)[0]


def solve_lasso(m: Moments, alpha: float, start: np.ndarray | None = None, rounds: int = 1000,
                tolerance: float = 1e-4) -> np.ndarray:
    """Coefficients that minimise the mean squared error / 2 plus
    ``alpha * |w|_1``, by coordinate descent on the moments, until no step
    changes the fitted values by more than ``tolerance`` label deviations."""
    _, xx, xy = m.centred()
    xx, xy = xx / m.n, xy / m.n
    spread = math.sqrt(max(m.second[-1, -1] / m.n - (m.first[-1] / m.n) ** 2, 0.0))
    w = [0.0] * len(xy) if start is None else [float(v) for v in start]
    slope, rows = (xy - xx @ np.array(w)).tolist(), xx.tolist()
    for _ in range(rounds):
        moved = 0.0
        for j, row in enumerate(rows):
            size = row[j]
            if size <= 0:
                continue
            rest = slope[j] + size * w[j]
            step = math.copysign(max(abs(rest) - alpha, 0.0), rest) / size - w[j]
            if step:
                slope = [s - step * r for s, r in zip(slope, row)]
                w[j] += step
                moved = max(moved, abs(step) * math.sqrt(size))
        if moved <= tolerance * spread:
            break
    return np.array(w)


def _linear_model(m: Moments, w: np.ndarray, features: Sequence[str], alpha: float) -> LinearModel:
    mean, _, _ = m.centred()
    return LinearModel(tuple(features), w, float(mean[-1] - w @ mean[:-1]), float(alpha))


def _cv_linear(df: DataFrame, features, label, alphas: Sequence[float], path, k: int, id_col: str,
               seed: int) -> tuple[LinearModel, DataFrame]:
    """``path(moments, alphas)`` gives the coefficients for all penalties.
    One pass over the data serves every penalty and fold: a fold's training
    moments are the total less its own, and its validation error follows from
    its own.  The penalty with the least mean error over the folds is fitted on
    all rows (ties: the first)."""
    fold = (hash_bucket(id_col, f"cv{seed}") % F.lit(k)).cast("int")
    own = fold_moments(df, features, label, fold)
    total = reduce(lambda a, b: a + b, own.values())
    errors = np.zeros((len(own), len(alphas)))
    for i, held in enumerate(own.values()):
        train = total - held
        for j, w in enumerate(path(train, alphas)):
            fitted = _linear_model(train, w, features, alphas[j])
            errors[i, j] = held.squared_error(w, fitted.intercept) / held.n
    mean = errors.mean(axis=0)
    best = int(mean.argmin())
    model = _linear_model(total, path(total, alphas)[best], features, alphas[best])
    scores = df.sparkSession.createDataFrame([(float(a), float(e)) for a, e in zip(alphas, mean)],
                                             "alpha double, cv_mse double")
    return model, scores


def train_ridge_cv(df: DataFrame, features: Sequence[str], label: str, id_col: str,
                   alphas: Sequence[float] = RIDGE_ALPHAS, k: int = 5,
                   seed: int = 42) -> tuple[LinearModel, DataFrame]:
    """Ridge regression (penalty ``alpha * |w|^2`` on the summed squared
    error), penalty chosen by k-fold CV."""
    return _cv_linear(df, features, label, list(alphas), lambda m, al: [solve_ridge(m, a) for a in al], k, id_col, seed)


def loo_errors(df: DataFrame, features: Sequence[str], label: str, m: Moments, alphas: Sequence[float]) -> list[float]:
    """Per penalty the mean squared error of every row by the ridge fitted on
    all others, from one pass: a row's residual over one minus its leverage."""
    mean, xx, _ = m.centred()
    d = len(features)
    fits = [(solve_ridge(m, a), np.linalg.pinv(xx + a * np.eye(d), hermitian=True)) for a in alphas]

    def run(batches):
        sums = np.zeros(len(fits))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - mean
            for i, (w, inverse) in enumerate(fits):
                leverage = 1 / m.n + np.einsum("ij,ij->i", x[:, :d] @ inverse, x[:, :d])
                error = (x[:, d] - x[:, :d] @ w) / np.maximum(1 - leverage, 1e-12)
                sums[i] += error @ error
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(fits)), pa.int32()), pa.array(sums)], names=["i", "s"])

    rows = df.select(*(F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate([*features, label])))
    found = {r.i: r.s for r in rows.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return [found[i] / m.n for i in range(len(fits))]


def train_ridge_loo(df: DataFrame, features: Sequence[str], label: str,
                    alphas: Sequence[float] = RIDGE_ALPHAS) -> tuple[LinearModel, DataFrame]:
    """Ridge regression with the penalty of the least leave-one-out error
    (ties: the first), which is the original's choice when no folds are given;
    two passes over the data after the one for the means."""
    m = fold_moments(df, features, label, F.lit(0))[0]
    errors = loo_errors(df, features, label, m, list(alphas))
    alpha = list(alphas)[int(np.argmin(errors))]
    scores = df.sparkSession.createDataFrame([(float(a), float(e)) for a, e in zip(alphas, errors)], "alpha double, loo_mse double")
    return _linear_model(m, solve_ridge(m, alpha), features, alpha), scores


def lasso_alpha_grid(total: Moments, n_alphas: int = LASSO_N_ALPHAS, eps: float = LASSO_EPS) -> list[float]:
    """The default lasso path: ``n_alphas`` log-spaced values from
    alpha_max = max_j |x_j . (y - mean y)| / n down to eps * alpha_max."""
    _, _, xy = total.centred()
    amax = float(np.abs(xy).max()) / total.n or 1.0
    return [float(a) for a in np.logspace(math.log10(amax), math.log10(amax * eps), n_alphas)]


def lasso_path(m: Moments, alphas: Sequence[float]) -> list[np.ndarray]:
    """Solutions for all penalties, each started at the one before."""
    out, w = [], None
    for a in alphas:
        w = solve_lasso(m, a, w)
        out.append(w)
    return out


def train_lasso_cv(df: DataFrame, features: Sequence[str], label: str, id_col: str,
                   alphas: Sequence[float] | None = None, n_alphas: int = LASSO_N_ALPHAS, k: int = 5,
                   seed: int = 42) -> tuple[LinearModel, DataFrame]:
    """Lasso, penalty chosen by k-fold CV (default: the path of
    :func:`lasso_alpha_grid`)."""
    if alphas is None:
        alphas = lasso_alpha_grid(fold_moments(df, features, label, F.lit(0))[0], n_alphas)
    return _cv_linear(df, features, label, list(alphas), lasso_path, k, id_col, seed)


# ---------------------------------------------------------------------------
# L8 kernel regression (random Fourier features, epsilon-insensitive loss)
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class RbfModel:
    """Fitted weights of random features; scoring is one projection."""
    features: tuple[str, ...]
    means: dict
    stds: dict
    w: np.ndarray
    b: np.ndarray
    weights: np.ndarray
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        z = [(F.col(f"`{c}`").cast("double") - F.lit(self.means[c])) / F.lit(self.stds[c]) for c in self.features]
        scale, score = math.sqrt(2.0 / len(self.b)), F.lit(self.intercept)
        for j in range(len(self.b)):
            place = F.lit(float(self.b[j]))
            for i, zi in enumerate(z):
                place = place + zi * F.lit(float(self.w[j, i]))
            score = score + F.cos(place) * F.lit(float(scale * self.weights[j]))
        return df.withColumn(PREDICTION, score)


def insensitive_loss(x: np.ndarray, y: np.ndarray, params: np.ndarray, w: np.ndarray, b: np.ndarray, epsilon: float,
                     width: float) -> tuple[float, np.ndarray]:
    """Sum over rows of what their absolute error exceeds ``epsilon`` by, and
    its gradient in (weights, intercept); within ``width`` of the border the
    corner is rounded by a parabola (at most ``width / 2`` below the loss)."""
    z = math.sqrt(2.0 / len(b)) * np.cos(w @ x + b[:, None])
    error = params[:-1] @ z + params[-1] - y[0]
    over = np.maximum(np.abs(error) - epsilon, 0.0)
    slope = np.minimum(over / width, 1.0) * np.sign(error)
    value = np.where(over < width, over * over / (2 * width), over - width / 2).sum()
    return float(value), np.append(z @ slope, slope.sum())


def train_rbf_regressor(df: DataFrame, features: Sequence[str], label: str, gamma: float = 0.01, c: float = 0.01,
                        epsilon: float = 0.1, n_components: int = 100, width: float = 1e-3, max_iter: int = 200,
                        seed: int = 42) -> RbfModel:
    """Standard scaler (population std) + support vector regression: half
    the squared norm of the weights plus ``c`` times the summed
    epsilon-insensitive loss.  The RBF kernel is approximated by
    ``n_components`` random Fourier features (W ~ N(0, 2 gamma), b ~ U(0, 2pi)),
    the loss by one that is smooth within ``width`` of its corner, so that the
    objective is within ``c * rows * width / 2`` of the exact one; L-BFGS over
    block gradients."""
    from tabkit.operators.scale import apply_standard, fit_standard
    std = fit_standard(df, list(features))
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, len(features)))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    none = Bins(tuple(np.empty(0) for _ in features))
    with dealt_rows(apply_standard(df, std).select(*(F.col(f"`{c}`") for c in dict.fromkeys([*features, label])))) as rows:
        blocks = materialize(pack_blocks(rows, features, [F.col(f"`{label}`")], F.lit(0), none, values=True))

    def evaluate(params: np.ndarray) -> tuple[float, np.ndarray]:
        value, gradient = summed_loss(blocks, 1, len(features),
                                      lambda x, y, p: insensitive_loss(x, y, p, w, b, epsilon, width), params)
        inner = np.append(params[:-1], 0.0)
        return c * value + inner @ inner / 2, c * gradient + inner

    best, _ = minimise(evaluate, np.zeros(n_components + 1), max_iter)
    return RbfModel(tuple(features), std.means, std.scales, w, b, best[:-1], float(best[-1]))


# ---------------------------------------------------------------------------
# L9 randomized search
# ---------------------------------------------------------------------------
def draw_param_sets(grid: Mapping[str, Sequence], n_iter: int, seed: int) -> list[dict]:
    """Seeded draw of ``n_iter`` distinct points of the grid's Cartesian
    product without enumerating it (mixed-radix decoding of sampled ranks)."""
    keys = list(grid)
    sizes = [len(grid[k]) for k in keys]
    total = math.prod(sizes)
    picks = random.Random(seed).sample(range(total), min(n_iter, total))
    out = []
    for r in picks:
        point = {}
        for k, s in zip(reversed(keys), reversed(sizes)):
            r, i = divmod(r, s)
            point[k] = grid[k][i]
        out.append({k: point[k] for k in keys})
    return out


def random_search(df: DataFrame, features: Sequence[str], label: str, id_col: str,
                  grid: Mapping[str, Sequence] = SEARCH_GRID, n_iter: int = SEARCH_ITER,
                  k: int = SEARCH_FOLDS, seed: int = 42, metric: str = "mae",
                  local_rows: int = LOCAL_ROWS) -> tuple[BoostedModel, DataFrame]:
    """Randomized search over boosted-tree settings with k-fold CV; the
    lowest mean ``metric`` (``mae`` or ``mse``) over the folds wins, ties go to
    the first draw, and the best settings are fitted on all rows.  All draws and
    folds are models of one table of binned rows, watched on their own fold.
    Returns (best model, table of (draw, params..., cv_metric))."""
    draws = draw_param_sets(grid, n_iter, seed)
    fold = hash_bucket(id_col, f"cv{seed}") % F.lit(k)
    sets = [c for f in range(k) for c in (fold != f, fold == f)] + [F.lit(True)]
    specs = [boosting_spec(d, seed=seed, train=2 * f, watch=2 * f + 1) for d in draws for f in range(k)]
    found, bins = boost_many(df, features, label, specs, sets, id_col, keep_trees=False, local_rows=local_rows)
    column = {"mae": 5, "mse": 4}[metric]
    scores = [float(np.mean([f.watched(column)[-1] for f in found[i * k:(i + 1) * k] if f.curve[-1, 3]]))
              for i in range(len(draws))]
    best = boosting_spec(draws[int(np.argmin(scores))], seed=seed, train=2 * k)
    (winner,), _ = boost_many(df, features, label, [best], sets, id_col, local_rows=local_rows, bins=bins)
    rows = [(i, *[float(d[key]) for key in grid], s) for i, (d, s) in enumerate(zip(draws, scores))]
    schema = "draw int, " + ", ".join(f"{key} double" for key in grid) + f", cv_{metric} double"
    return (BoostedModel(tuple(features), winner.spec.loss, winner.base, winner.trees),
            df.sparkSession.createDataFrame(rows, schema))


# ---------------------------------------------------------------------------
# L10 / L11 importances
# ---------------------------------------------------------------------------
def _tree_stage(model: PipelineModel):
    return model.stages[-1]


def feature_importance(model, features: Sequence[str], kind: str = "mean") -> DataFrame:
    """(feature, importance, rank) from a fitted tree model, descending;
    ``kind`` (boosted models): ``mean`` gain of a feature's splits, or their
    ``total`` gain."""
    if isinstance(model, BoostedModel):
        imp = model.importances(kind)
    else:
        imp = (_tree_stage(model) if isinstance(model, PipelineModel) else model).featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = sorted(((f, float(v)) for f, v in zip(features, imp)), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def importance_study(df: DataFrame, features: Sequence[str], label: str, id_col: str, n: int = 100,
                     frac: float = 0.4, params: Mapping | None = None, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Importances over ``n`` random splits (seeds 0..n-1): each split's
    training side fits a boosted classifier (100 rounds, depth 5, seeded by
    the split); returns the long table ``(seed, feature, importance)``, shares
    of the total gain.  A row carries its side in all splits, and all models
    advance over the same binned rows."""
    sets = [hash_bucket(id_col, seed) >= F.lit(int(frac * HASH_SPACE)) for seed in range(n)]
    specs = [boosting_spec({**STUDY_DEFAULTS, **(params or {})}, seed=seed, train=seed, newton=False, loss=LOGISTIC)
             for seed in range(n)]
    found, _ = boost_many(df, features, label, specs, sets, id_col, local_rows=local_rows)
    rows = [(seed, f, float(v)) for seed, m in enumerate(found)
            for f, v in zip(features, tree_importances(m.trees, len(features), "total"))]
    return df.sparkSession.createDataFrame(rows, "seed int, feature string, importance double")


def importance_summary(long: DataFrame) -> DataFrame:
    """L11 report: mean importance, mean rank within a split, and box
    statistics per feature."""
    from pyspark.sql import Window
    from tabkit.operators.profile import box_stats
    w = Window.partitionBy("seed").orderBy(F.desc("importance"), "feature")
    ranked = long.withColumn("rank", F.row_number().over(w))
    means = ranked.groupBy("feature").agg(F.avg("importance").alias("mean_importance"),
                                          F.avg("rank").alias("mean_rank"))
    wide = long.groupBy("seed").pivot("feature").agg(F.first("importance"))
    feats = [r["feature"] for r in means.select("feature").collect()]
    box = box_stats(wide, feats).withColumnRenamed("column", "feature")
    return means.join(box, "feature").orderBy(F.desc("mean_importance"), "feature")


# ---------------------------------------------------------------------------
# L12 staged error, L13 CV report, L15 early stopping
# ---------------------------------------------------------------------------
def staged_error(model: PipelineModel, train: DataFrame, valid: DataFrame,
                 loss: str | None = None, class_error: bool = False) -> DataFrame:
    """Training and validation loss after each boosting round
    (``evaluateEachIteration``: executors score every prefix of the
    ensemble in one pass per dataset).  Regression losses: squared or
    absolute; classification: logistic, plus (``class_error``) the error
    rate of the 0/1 predictions per round (:func:`staged_class_error`)."""
    gbt = _tree_stage(model)
    asm = model.stages[0]
    tr, va = asm.transform(train), asm.transform(valid)
    from pyspark.ml.regression import GBTRegressionModel
    if isinstance(gbt, GBTRegressionModel):
        loss = loss or gbt.getLossType()
        te, ve = gbt.evaluateEachIteration(tr, loss), gbt.evaluateEachIteration(va, loss)
    else:
        te, ve = gbt.evaluateEachIteration(tr), gbt.evaluateEachIteration(va)
    spark = train.sparkSession
    out = spark.createDataFrame([(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(te, ve))],
                                "iteration int, train_loss double, valid_loss double")
    if class_error and not isinstance(gbt, GBTRegressionModel):
        label = gbt.getLabelCol()
        tr_e = staged_class_error(model, train, label).withColumnRenamed("class_error", "train_class_error")
        va_e = staged_class_error(model, valid, label).withColumnRenamed("class_error", "valid_class_error")
        out = out.join(tr_e, "iteration").join(va_e, "iteration")
    return out


def parse_tree(tree) -> tuple:
    """A fitted tree as nested ``(feature, threshold, left, right)``, leaves as
    numbers, from its text form."""
    lines = [line.strip() for line in tree.toDebugString.splitlines()[1:] if line.strip()]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return float(line.split(":", 1)[1])
        found = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
        if not found:
            raise ValueError(f"not a split on a number: {line}")
        left = node()
        at += 1  # the Else line
        return int(found[1]), float(found[2]), left, node()

    return node()


def tree_outputs(tree, x: np.ndarray) -> np.ndarray:
    """Outputs of a parsed tree for the rows of ``x``."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    feature, threshold, left, right = tree
    low = x[:, feature] <= threshold
    out = np.empty(len(x))
    out[low], out[~low] = tree_outputs(left, x[low]), tree_outputs(right, x[~low])
    return out


def staged_class_error(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """L12 for classifiers: the class error (= MSE of 0/1 predictions) after
    each boosting round, ``(iteration, class_error)``.

    One pass: in each Arrow batch the trees (broadcast with the function;
    their size is the model's) add to the margin round by round, the class is
    ``margin > 0``, and a task sends its count of errors per round."""
    gbt = _tree_stage(model)
    trees, weights = [parse_tree(t) for t in gbt.trees], [float(w) for w in gbt.treeWeights]
    data = model.stages[0].transform(df).select(vector_to_array(FEATURES).alias("x"), F.col(label).cast("double").alias("y"))

    def run(batches):
        wrong, n = np.zeros(len(trees), np.int64), 0
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(y):
                continue
            x = batch.column(0).flatten().to_numpy().reshape(len(y), -1)
            margin = np.zeros(len(y))
            for i, (tree, w) in enumerate(zip(trees, weights)):
                margin += w * tree_outputs(tree, x)
                wrong[i] += np.count_nonzero((margin > 0) != (y == 1))
            n += len(y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, len(trees) + 1), pa.int32()), pa.array(wrong),
                                          pa.array(np.full(len(trees), n, np.int64))], names=["iteration", "wrong", "n"])

    counted = data.mapInArrow(run, "iteration int, wrong bigint, n bigint")
    return counted.groupBy("iteration").agg((F.sum("wrong") / F.sum("n")).alias("class_error"))


def staged_curve(df: DataFrame, features: Sequence[str], label: str, train: Column, valid: Column,
                 params: Mapping | None = None, id_col: str | None = None, classifier: bool = True,
                 seed: int = 1, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """``(iteration, train_loss, valid_loss, train_error, valid_error)``
    after each boosting round: mean log loss and share of wrong classes, or
    squared and absolute error.  The rounds are grown and scored in one go, on
    the rows where ``train`` and ``valid`` hold."""
    defaults = {**STAGED_DEFAULTS, "newton": False, "loss": LOGISTIC if classifier else SQUARED, "seed": seed}
    spec = boosting_spec({**defaults, **(params or {})}, train=0, watch=1)
    (m,), _ = boost_many(df, features, label, [spec], [train, valid], id_col, keep_trees=False, local_rows=local_rows)
    table = zip(m.trained(1).tolist(), m.watched(4).tolist(), m.trained(2).tolist(), m.watched(5).tolist())
    return df.sparkSession.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(table)],
        "iteration int, train_loss double, valid_loss double, train_error double, valid_error double")


def cv_report(df: DataFrame, features: Sequence[str], label: str, id_col: str, k: int = 5,
              seed: int = 42, params: Mapping | None = None, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Per fold, train and validation accuracy and AUC of a boosted
    classifier; long table ``(fold, side, metric, value)``.  All folds are
    models of one table; their scores come from one pass, and both metrics from
    one aggregate and one AUC pass grouped by (fold, side)."""
    folded = k_fold(df.select(id_col, label, *features), id_col, k, seed, "fold")
    specs = [boosting_spec({**GBC_DEFAULTS, **(params or {})}, seed=seed, train=f, newton=False, loss=LOGISTIC)
             for f in range(k)]
    found, _ = boost_many(folded, features, label, specs, [F.col("fold") != f for f in range(k)], id_col,
                          local_rows=local_rows)
    models = [BoostedModel(tuple(features), LOGISTIC, m.base, m.trees) for m in found]
    return fold_metrics(score_folds(folded, models, label), label)


def score_folds(folded: DataFrame, models: Sequence[BoostedModel], label: str) -> DataFrame:
    """``fold`` (of the model), ``side`` (``valid`` where it is the row's own),
    ``label``, ``p1`` and ``prediction`` of every row by every model."""
    held = folded.sparkSession.sparkContext.broadcast(list(models))

    @F.pandas_udf("array<double>")
    def margins(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
            yield pd.Series(list(np.stack([m.margin(x) for m in held.value], 1)))

    each = folded.select(F.col("fold").alias("row_fold"), label, F.posexplode(
        margins(*(F.col(f"`{c}`").cast("double") for c in models[0].features))).alias("fold", "m"))
    side = F.when(F.col("row_fold") == F.col("fold"), "valid").otherwise("train")
    return each.select("fold", side.alias("side"), label, (1 / (1 + F.exp(-F.col("m")))).alias("p1"),
                       (F.col("m") > 0).cast("double").alias(PREDICTION))


def fold_metrics(scored: DataFrame, label: str, score: str = "p1", prediction: str = PREDICTION) -> DataFrame:
    """``(fold, side, metric, value)`` from rows with ``fold``, ``side``,
    a score and a predicted class."""
    from tabkit.operators.metrics import accuracy_col, roc_auc
    scored = materialize(scored)
    acc = scored.groupBy("fold", "side").agg(accuracy_col(label, prediction).alias("accuracy"))
    auc = roc_auc(scored, label, score, ["fold", "side"])
    return acc.join(auc, ["fold", "side"]).unpivot(["fold", "side"], ["accuracy", "auc"], "metric", "value")


def train_with_patience(df: DataFrame, features: Sequence[str], label: str, watch: Column,
                        params: Mapping | None = None, patience: int = PATIENCE, min_delta: float = MIN_DELTA,
                        id_col: str | None = None, classifier: bool = False, seed: int = 42,
                        local_rows: int = LOCAL_ROWS) -> tuple[BoostedModel, DataFrame]:
    """Boosting that ends after ``patience`` rounds without a gain of more
    than ``min_delta`` in the loss on the rows where ``watch`` holds (it is
    trained on the others), cut at its best round.  Returns the model and the
    curve ``(iteration, train_loss, valid_loss, best)``."""
    spec = boosting_spec(params, loss=LOGISTIC if classifier else SQUARED, seed=seed, patience=patience, min_delta=min_delta)
    model, m = boost(df, features, label, spec, id_col, ~watch, watch, local_rows)
    rows = [(i + 1, a, b, i + 1 == m.best_round) for i, (a, b) in enumerate(zip(m.trained(1).tolist(), m.watched(4).tolist()))]
    return model, df.sparkSession.createDataFrame(rows, "iteration int, train_loss double, valid_loss double, best boolean")


def train_with_validation(df: DataFrame, features: Sequence[str], label: str, indicator: str,
                          params: Mapping | None = None, tol: float = 0.01, seed: int = 42,
                          classifier: bool = False) -> PipelineModel:
    """Boosting that stops once the validation loss (rows where
    ``indicator`` is true) stops improving by ``tol``."""
    base = GBT_CLASSIFIER_DEFAULTS if classifier else GBT_REGRESSOR_DEFAULTS
    p = dict(base, **gbt_params_from_boosting(params or {}))
    cls = GBTClassifier if classifier else GBTRegressor
    est = cls(featuresCol=FEATURES, labelCol=label, seed=seed, validationIndicatorCol=indicator,
              validationTol=tol, **p)
    return _fit([assembler(features), est], df)


# ---------------------------------------------------------------------------
# L7 stacking (with R5 out-of-fold predictions)
# ---------------------------------------------------------------------------
# A base learner: fit(train) -> score(df) adding column PREDICTION.
BaseLearner = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


def spark_learner(make: Callable[[DataFrame], PipelineModel]) -> BaseLearner:
    def fit(train: DataFrame):
        m = make(train)
        return m.transform
    return fit


def knn_learner(id_col: str, features: Sequence[str], label: str, k: int = 20) -> BaseLearner:
    """k-nearest-neighbour regression (V4) as a base learner; rows of few
    features form clusters, so in large tables pivots rule partitions out."""
    from tabkit.operators.similar import as_vector, knn_regress

    def fit(train: DataFrame):
        tr = train.select(id_col, label, as_vector(features).alias("__vec"))

        def score(df: DataFrame) -> DataFrame:
            q = df.select(id_col, as_vector(features).alias("__vec"))
            pred = knn_regress(tr, q, id_col, "__vec", label, k, PREDICTION, prune=None)
            return df.join(pred, id_col, "left")
        return score
    return fit


def oof_predict(df: DataFrame, learner: BaseLearner, id_col: str, k: int = 5, seed: int = 42,
                out_col: str = PREDICTION, parallelism: int = 4) -> DataFrame:
    """Out-of-fold predictions ``(id, out_col)``: every row is scored by
    the model fitted on the other k-1 folds.  The input is computed once
    (reliable checkpoint); the k fits are independent Spark jobs submitted
    concurrently from a thread pool."""
    folded = materialize(k_fold(df, id_col, k, f"oof{seed}", "__oof_fold"))

    def one(f: int) -> DataFrame:
        score = learner(folded.where(F.col("__oof_fold") != f).drop("__oof_fold"))
        held = folded.where(F.col("__oof_fold") == f).drop("__oof_fold")
        return score(held).select(id_col, F.col(PREDICTION).alias(out_col))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
        parts = list(pool.map(one, range(k)))
    return reduce(DataFrame.unionByName, parts)


@dataclass
class StackModel:
    bases: dict            # name -> scoring function fitted on all training rows
    final: BoostedModel
    id_col: str

    def transform(self, df: DataFrame) -> DataFrame:
        out = df = materialize(df)  # read by every base
        for name, score in self.bases.items():
            out = out.join(score(df).select(self.id_col, F.col(PREDICTION).alias(f"pred_{name}")),
                           self.id_col, "left")
        return self.final.transform(out)


def train_stack(df: DataFrame, bases: Mapping[str, BaseLearner], label: str, id_col: str, k: int = 5,
                seed: int = 42, final_params: Mapping | None = None, parallelism: int = 4) -> StackModel:
    """Stacking.  Each base's out-of-fold predictions (R5) become the
    features of a small boosted model (25 rounds, depth 3, subsample 0.5, min leaf
    25, one feature per split); for scoring the bases are refitted on all rows.
    Bases are fitted concurrently; out-of-fold tables are checkpointed
    (reliable checkpoint in the shared folder) so the final fit does not
    recompute k fits per base."""
    names = list(bases)
    df = materialize(df)  # read by every base, fold and refit

    def oof(name: str) -> DataFrame:
        return oof_predict(df, bases[name], id_col, k, seed, f"pred_{name}", parallelism).checkpoint(eager=True)

    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        oofs = list(pool.map(oof, names))
        refits = list(pool.map(lambda n: bases[n](df), names))
    feats = df
    for o in oofs:
        feats = feats.join(o, id_col)
    spec = boosting_spec({**STACK_FINAL_DEFAULTS, **(final_params or {})}, seed=seed)
    final, _ = boost(feats, [f"pred_{n}" for n in names], label, spec, id_col)
    return StackModel(dict(zip(names, refits)), final, id_col)


# ---------------------------------------------------------------------------
# L14 fixed dense network, L16 MLP classifier
# ---------------------------------------------------------------------------
def score_dense(df: DataFrame, features: Sequence[str], layers: Sequence[tuple], mean=None, std=None,
                out_col: str = "score", final: str = "identity") -> DataFrame:
    """Batch scoring with a fixed dense network: optional normalisation,
    then ``(W, b)`` layers with ReLU between them and ``final`` (identity or
    sigmoid) at the end.  An Arrow-batched pandas UDF does the matrix
    products in numpy; the weights (small, fixed) travel with the function."""
    from pyspark.sql.functions import pandas_udf
    ws = [(np.asarray(w, dtype=np.float64), np.asarray(b, dtype=np.float64)) for w, b in layers]
    mu = np.asarray(mean if mean is not None else np.zeros(len(features)), dtype=np.float64)
    sd = np.asarray(std if std is not None else np.ones(len(features)), dtype=np.float64)

    @pandas_udf("double")
    def forward(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in cols])
        h = (x - mu) / sd
        for i, (w, b) in enumerate(ws):
            h = h @ w + b
            if i < len(ws) - 1:
                h = np.maximum(h, 0.0)
        y = h[:, 0]
        if final == "sigmoid":
            y = 1.0 / (1.0 + np.exp(-y))
        return pd.Series(y)

    return df.withColumn(out_col, forward(*[F.col(f"`{c}`").cast("double") for c in features]))


def replicate_by_weight(df: DataFrame, weight_col: str, id_col: str, seed: int = 0) -> DataFrame:
    """Turn real-valued row weights into row copies (for learners without a
    weight column): floor(w) copies plus one more with probability frac(w),
    decided by a hash of the key (deterministic).  A null weight is an error."""
    w = F.col(weight_col).cast("double")
    extra = (hash_bucket(id_col, seed).cast("double") / F.lit(float(HASH_SPACE))) < (w - F.floor(w))
    n = F.coalesce((F.floor(w) + extra.cast("int")).cast("int"),
                   F.raise_error(F.lit(f"null weight in {weight_col}")).cast("int"))
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.greatest(n, F.lit(1))))) \
        .where(F.col("__copy") <= n).drop("__copy")


@dataclass(frozen=True)
class NetModel:
    """A dense network for class 1, over standardised features."""
    features: tuple[str, ...]
    layers: list[tuple[np.ndarray, np.ndarray]]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``p1`` and ``prediction``."""
        out = score_dense(df, self.features, self.layers, out_col="p1", final="sigmoid")
        return out.withColumn(PREDICTION, (F.col("p1") > 0.5).cast("double"))


def net_layers(params: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Parameters in one row as (matrix, bias) per layer."""
    out, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        out.append((params[at:at + a * b].reshape(a, b), params[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def net_loss(x: np.ndarray, y: np.ndarray, params: np.ndarray, sizes: Sequence[int]) -> tuple[float, np.ndarray]:
    """Sum over rows of weight times log loss of a dense network (rectified
    hidden layers, one logit), and its gradient; ``y``: classes and weights."""
    layers = net_layers(params, sizes)
    held = [x.T]
    for i, (w, b) in enumerate(layers):
        h = held[-1] @ w + b
        held.append(np.maximum(h, 0.0) if i < len(layers) - 1 else h)
    logit, (truth, weight) = held[-1][:, 0], y
    value = float(weight @ np.logaddexp(0, np.where(truth > 0.5, -logit, logit)))
    back = (weight * (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - truth))[:, None]
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        parts += [back.sum(axis=0), (held[i].T @ back).ravel()]
        if i:
            back = (back @ layers[i][0].T) * (held[i] > 0)
    return value, np.concatenate(parts[::-1])


def train_net(df: DataFrame, features: Sequence[str], label: str, hidden: Sequence[int], weight_col: str | None = None,
              max_iter: int = 100, seed: int = 42) -> NetModel:
    """A dense network for a 0/1 label, trained by L-BFGS on the weighted mean
    log loss; a row of weight 2 counts as two rows.  Missing weights and
    labels are an error."""
    sizes = [len(features), *hidden, 1]
    weight = F.col(f"`{weight_col}`").cast("double") if weight_col else F.lit(1.0)
    none = Bins(tuple(np.empty(0) for _ in features))
    with dealt_rows(df.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*features, label])), weight.alias("_weight"))) as rows:
        blocks = materialize(pack_blocks(rows, features, [F.col(f"`{label}`"), F.col("_weight")], F.lit(0), none, values=True))
        total = rows.agg(F.sum("_weight")).first()[0] or 1.0
    rng = np.random.default_rng(seed)
    start = np.concatenate([np.append(rng.normal(0, math.sqrt(2 / a), a * b), np.zeros(b)) for a, b in zip(sizes[:-1], sizes[1:])])

    def evaluate(params: np.ndarray) -> tuple[float, np.ndarray]:
        value, gradient = summed_loss(blocks, 2, len(features), lambda x, y, p: net_loss(x, y, p, sizes), params)
        return value / total, gradient / total

    return NetModel(tuple(features), net_layers(minimise(evaluate, start, max_iter)[0], sizes))


def train_mlp_classifier(df: DataFrame, features: Sequence[str], label: str, id_col: str | None = None,
                         hidden: Sequence[int] = MLP_HIDDEN, weight_col: str | None = None,
                         max_iter: int = 100, seed: int = 42) -> tuple[NetModel, object]:
    """Binary dense network on standardised features (population std,
    fitted on the training rows), with row weights in the loss.  Returns the
    model and the fitted scaler parameters (for scoring new rows)."""
    from tabkit.operators.scale import apply_standard, fit_standard
    std = fit_standard(df, list(features))
    return train_net(apply_standard(df, std), features, label, hidden, weight_col, max_iter, seed), std


# ---------------------------------------------------------------------------
# L17-L19 pipelines, submission, best model
# ---------------------------------------------------------------------------
def make_pipeline(stages) -> Pipeline:
    """Preprocessing + model as one estimator."""
    return Pipeline(stages=list(stages))


def fit_predict_submit(train: DataFrame, test: DataFrame, estimator, id_col: str, path: str | None = None,
                       pred_col: str = PREDICTION, score: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Refit on all training rows, score the test rows, emit
    ``(id, prediction)`` and write it as a headered CSV when ``path`` is
    given (S4)."""
    model = _fit_dealt(estimator, train)
    pred = model.transform(test)
    value = score(pred) if score is not None else F.col(PREDICTION)
    out = pred.select(id_col, value.alias(pred_col))
    if path:
        from tabkit.sources.io import write_predictions
        write_predictions(out, path, id_col, pred_col)
    return out


def best_row(metrics: DataFrame, metric: str, mode: str = "max", key: str = "run_id") -> DataFrame:
    """The row with the best ``metric`` column (ties by ``key``), as a
    one-row frame (TakeOrdered: per-task best, one tiny merge)."""
    order = F.desc(metric) if mode == "max" else F.asc(metric)
    return metrics.orderBy(order, F.asc(key)).limit(1)


def select_best(models: Mapping[str, object], metric: Callable[[object], float], mode: str = "max",
                path: str | None = None) -> tuple[str, object, dict[str, float]]:
    """The model with the best ``metric`` (a function of the model; ties
    go to the first, a NaN never wins), and every model's value.  Only that
    model is saved under ``path``."""
    values = {name: float(metric(m)) for name, m in models.items()}
    sign = 1.0 if mode == "max" else -1.0
    known = [name for name, v in values.items() if not math.isnan(v)]
    if not known:
        raise ValueError("no model has a value")
    best = max(known, key=lambda name: sign * values[name])
    if path:
        save_model(models[best], path)
    return best, models[best], values


def save_model(model, path: str) -> str:
    """Persist a fitted pipeline (executors write the tree data)."""
    model.write().overwrite().save(path)
    return path
