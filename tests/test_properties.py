"""Property tests: the distributed algorithms built on bucketed prefix sums
(exact quantiles, AUC, tail split) against brute force on random inputs."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabkit.operators import metrics as K
from tabkit.operators import profile as A
from tabkit.operators import split as R

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.integers(min_value=-20, max_value=20), min_size=1, max_size=60)


@SETTINGS
@given(xs=values, buckets=st.integers(min_value=1, max_value=9))
def test_exact_quantiles_match_numpy(spark, xs, buckets):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    probs = (0.1, 0.25, 0.5, 0.75, 0.9)
    got = {r.prob: r.value for r in A.exact_quantiles(df, ["x"], probs, n_buckets=buckets).collect()}
    want = np.quantile(np.array(xs, dtype=float), probs)  # linear interpolation
    for p, w in zip(probs, want):
        assert got[p] == pytest.approx(w, abs=1e-9)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=50))
def test_auc_matches_pairwise_count(spark, pairs):
    df = spark.createDataFrame([(y, float(s)) for y, s in pairs], "y int, s double")
    got = K.roc_auc(df, "y", "s").first().auc
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        assert got is None
        return
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert got == pytest.approx(wins / (len(pos) * len(neg)))
    roc = K.roc_curve(df, "y", "s").collect()
    assert len(roc) == len({s for _, s in pairs}) + 1


@SETTINGS
@given(xs=st.lists(st.integers(0, 30), min_size=1, max_size=60), frac=st.sampled_from([0.1, 0.2, 0.5]))
def test_tail_split_cut(spark, xs, frac):
    """Validation = every key whose first position in key order is at or
    after floor(n * (1 - frac)); a tie group straddling the boundary stays
    in training (equal keys have no order to split them by)."""
    df = spark.createDataFrame([(x,) for x in xs], "t int")
    train, val = R.tail_split(df, "t", frac)
    split_at = int(np.floor(len(xs) * (1 - frac)))
    first_pos = {k: sum(1 for x in xs if x < k) for k in set(xs)}
    want = sorted(x for x in xs if first_pos[x] >= split_at)
    assert sorted(r.t for r in val.collect()) == want
    assert train.count() + val.count() == len(xs)
