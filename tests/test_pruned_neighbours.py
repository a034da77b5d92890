"""Neighbours with partitions ruled out by pivots: the result of scoring all
pairs, with fewer pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import similar as V


def vectors(spark, v, name):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], f"{name} long, v array<double>")


def both(spark, q, items, k, metric, exclude_self=False, **kw):
    a, b = vectors(spark, q, "q"), vectors(spark, items, "i")
    want = V.top_k_neighbours(a, b, "q", "v", "i", "v", k, metric, exclude_self)
    got, stats = V.top_k_pruned(a, b, "q", "v", "i", "v", k, metric, exclude_self, **kw)
    rows = [sorted((r.q, r["rank"], r.i, round(r.score, 9)) for r in d.collect()) for d in (want, got)]
    return rows[0], rows[1], stats.first()


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_clustered_vectors(spark, metric):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 6)) * 10
    items = np.concatenate([c + rng.normal(size=(40, 6)) * 0.05 for c in centres])
    q = items[::7] + 0.01
    want, got, stats = both(spark, q, items, 5, metric, query_block=20, item_block=16, pivots=60)
    assert got == want
    assert stats.pairs == len(q) * len(items) and stats.scored < 0.2 * stats.pairs


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_ties_zero_vectors_and_few_items(spark, metric):
    rng = np.random.default_rng(3)
    items = rng.integers(-1, 2, size=(90, 3)).astype(float)  # many equal and zero vectors
    for n in (90, 4):
        for k in (1, 7):
            want, got, _ = both(spark, items[:n], items[:n], k, metric, exclude_self=True, query_block=7, item_block=5)
            assert got == want
    want, got, _ = both(spark, items[:3], np.zeros((5, 3)), 2, metric)
    assert got == want and len(got) == 6


def test_no_items_and_no_queries(spark):
    some, none = np.ones((2, 2)), np.zeros((0, 2))
    for q, i in ((some, none), (none, some)):
        got, stats = V.top_k_pruned(vectors(spark, q, "q"), vectors(spark, i, "i"), "q", "v", "i", "v", 2)
        assert got.collect() == [] and stats.first().scored == 0


def test_regression_is_the_same(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=3)], float(i % 5)) for i in range(120)]
    d = spark.createDataFrame(rows, "id long, v array<double>, y double")
    train, query = d.where("id % 3 > 0"), d.where("id % 3 = 0")
    a, b = (V.knn_regress(train, query, "id", "v", "y", 6, prune=p).orderBy("id") for p in (False, True))
    assert {r.id: r.prediction for r in a.collect()} == pytest.approx({r.id: r.prediction for r in b.collect()})


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_where_nothing_is_ruled_out_a_query_is_sent_once_a_bundle(spark, metric, monkeypatch):
    """not once for each partition."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 24))
    sent, met = [], V._met
    monkeypatch.setattr(V, "_met", lambda wanted, *a, **kw: (sent.append(wanted.count()), met(wanted, *a, **kw))[1])
    want, got, stats = both(spark, v, v, 10, metric, exclude_self=True, query_block=150, item_block=100, pivots=40)
    assert got == want
    assert stats.scored > 0.9 * stats.pairs and sum(sent) < 2 * len(v) * 8


def test_copies_grow_with_the_table():
    """F16: blocks grow with the table, so that it is not copied more and more."""
    assert V._n_blocks(3 * V.DEFAULT_BLOCK, None) == 3
    assert V._n_blocks(100_000, None) == V._n_blocks(500_000, None) == V.SPREAD
    assert V._n_blocks(10_000_000, None) <= 10_000_000 / V.MAX_BLOCK + 1


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("decimals", [9, None])
def test_pieces_give_the_best_of_all(metric, decimals, monkeypatch):
    """pairs ruled out by products of pieces are none of the best: near
    points far from the origin, ties, copies, missing values, own rows."""
    monkeypatch.setattr(V, "QUERY_ROWS", 7)
    monkeypatch.setattr(V, "ITEM_ROWS", 11)
    monkeypatch.setattr(V, "PAIR_ROWS", 5)
    rng = np.random.default_rng(6)
    far = 1e6 + rng.integers(0, 3, size=(60, 2)) * 1e-3
    grid = rng.integers(-1, 2, size=(60, 2)).astype(float)
    for v in (far, grid, rng.normal(size=(60, 5)), np.where(rng.random((60, 2)) < 0.1, np.nan, grid)):
        ids = np.arange(len(v))
        r, c, s = V._scan(v[::2], v, ids[::2], ids, 4, metric, True, decimals)
        if metric == "cosine":
            all_ = V._on_sphere(v[::2]) @ V._on_sphere(v).T
        else:
            all_ = -np.sqrt(((v[::2, None] - v[None]) ** 2).sum(axis=2))
        all_[np.arange(len(all_)), ids[::2]] = np.nan
        rank = np.round(all_, decimals) if decimals is not None else all_
        if decimals is None and metric == "cosine":  # ties differ in the last bit
            for i in range(len(all_)):
                best = np.sort(all_[i][np.isfinite(all_[i])])[::-1][:4]
                assert s[r == i] == pytest.approx(best)
            continue
        for i, row in enumerate(rank):
            usable = np.flatnonzero(np.isfinite(row))
            assert c[r == i].tolist() == usable[np.lexsort((usable, -row[usable]))][:4].tolist()


def test_stacked_neighbours_skip_partitions_of_large_tables(spark, monkeypatch):
    """the base learner's search is pruned from ``PRUNE_PAIRS`` on."""
    from tabkit.operators import models as L
    rng = np.random.default_rng(7)
    d = spark.createDataFrame([(i, *map(float, rng.normal(size=2)), float(i % 3)) for i in range(90)], "id long, a double, b double, y double")
    used, pruned = [], V.top_k_pruned
    monkeypatch.setattr(V, "top_k_pruned", lambda *a, **kw: (used.append(1), pruned(*a, **kw))[1])
    found = []
    for pairs in (10**9, 60 * 30):
        monkeypatch.setattr(V, "PRUNE_PAIRS", pairs)
        score = L.knn_learner("id", ["a", "b"], "y", 5)(d.where("id % 3 > 0"))
        found.append({r.id: r.prediction for r in score(d.where("id % 3 = 0")).collect()})
        assert len(used) == len(found) - 1
    assert found[0] == pytest.approx(found[1]) and len(found[0]) == 30
