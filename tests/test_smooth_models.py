"""Models fitted by summed gradients: weights as copies, the epsilon-insensitive
optimum, gradients."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import blocks as K
from tabkit.operators import lbfgs as M
from tabkit.operators import models as L


def frame(spark, x, *more):
    names = [f"x{i}" for i in range(x.shape[1])] + [f"y{i}" for i in range(len(more))]
    return spark.createDataFrame([tuple(map(float, (*r, *m))) for r, *m in zip(x, *more)], ", ".join(f"{n} double" for n in names)), names[:x.shape[1]]


def numeric(f, p, eps=1e-6):
    return np.array([(f(p + eps * e)[0] - f(p - eps * e)[0]) / (2 * eps) for e in np.eye(len(p))])


def test_gradients_are_those_of_the_values():
    rng = np.random.default_rng(1)
    x, y, w = rng.normal(size=(3, 30)), (rng.random(30) > 0.5).astype(float), rng.random(30) * 3
    sizes = [3, 4, 2, 1]
    p = rng.normal(size=3 * 4 + 4 + 4 * 2 + 2 + 2 + 1)
    f = lambda q: L.net_loss(x, np.stack([y, w]), q, sizes)
    assert f(p)[1] == pytest.approx(numeric(f, p), abs=1e-4)
    W, b, q = rng.normal(size=(6, 3)), rng.random(6), rng.normal(size=7)
    g = lambda r: L.insensitive_loss(x, y[None], r, W, b, 0.1, 0.05)
    assert g(q)[1] == pytest.approx(numeric(g, q), abs=1e-4)


def test_minimum_of_a_known_function():
    h = np.diag([1.0, 10.0, 200.0])
    x, value = M.minimise(lambda p: (float((p - 3) @ h @ (p - 3)), 2 * h @ (p - 3)), np.zeros(3), 200, 1e-14)
    assert x == pytest.approx([3, 3, 3], abs=1e-4) and value < 1e-6


def test_weights_are_copies(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 2))
    y, w = (x[:, 0] + 0.3 * rng.normal(size=60) > 0).astype(float), rng.integers(1, 4, 60).astype(float)
    weighted, feats = frame(spark, x, y, w)
    copies, _ = frame(spark, np.repeat(x, w.astype(int), 0), np.repeat(y, w.astype(int)))
    a = L.train_net(weighted, feats, "y0", (4,), "y1", 25)
    b = L.train_net(copies, feats, "y0", (4,), None, 25)
    for (u, c), (v, d) in zip(a.layers, b.layers):
        assert u == pytest.approx(v, rel=1e-4, abs=1e-6) and c == pytest.approx(d, rel=1e-4, abs=1e-6)
    with pytest.raises(Exception, match="labels"):
        L.train_net(weighted.withColumn("y1", F.when(F.col("y1") > 1, F.col("y1"))), feats, "y0", (4,), "y1", 2)


def test_summed_over_blocks_is_summed_over_rows(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(500, 2)), rng.normal(size=500)
    df, feats = frame(spark, x, y)
    blocks = K.pack_blocks(df.repartition(4), feats, [F.col("y0")], F.lit(0), K.Bins((np.empty(0),) * 2), values=True)
    W, b, p = rng.normal(size=(5, 2)), rng.random(5), rng.normal(size=6)
    f = lambda a, c, q: L.insensitive_loss(a, c, q, W, b, 0.1, 0.01)
    value, gradient = M.summed_loss(blocks, 1, 2, f, p)
    want = f(x.T, y[None], p)
    assert value == pytest.approx(want[0]) and gradient == pytest.approx(want[1])


def test_the_insensitive_optimum(spark):
    """Against a dense solution by many small subgradient steps; the objective
    may exceed it by the gap that rounding the corner allows, and not more."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 2))
    x = (x - x.mean(0)) / x.std(0)
    y = np.sin(x[:, 0]) + 0.2 * rng.normal(size=150)
    df, feats = frame(spark, x, y)
    m = L.train_rbf_regressor(df, feats, "y0", gamma=0.3, c=0.5, epsilon=0.1, n_components=12, max_iter=300)
    z = math.sqrt(2 / 12) * np.cos(x @ m.w.T + m.b)

    def objective(w, b):
        return 0.5 * np.maximum(np.abs(z @ w + b - y) - 0.1, 0).sum() + w @ w / 2

    w, b, best = np.zeros(12), 0.0, math.inf
    for i in range(60000):
        e = z @ w + b - y
        s = 0.5 * np.sign(e) * (np.abs(e) > 0.1)
        rate = 0.2 / (i + 20)
        w, b = w - rate * (z.T @ s + w), b - rate * s.sum() * 0.2
        best = min(best, objective(w, b))
    got = objective(m.weights, m.intercept)
    assert got <= best + 0.5 * 150 * 1e-3 / 2 + 1e-3 * best
    scored = [r.prediction for r in m.transform(df).collect()]
    assert np.sort(scored) == pytest.approx(np.sort(z @ m.weights + m.intercept))
