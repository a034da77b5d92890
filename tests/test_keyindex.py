"""Indexed ingest: the rows of the plain one, reading few files."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabkit.sources import ingest as I
from tabkit.sources import keyindex as X


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), max_size=300), st.lists(st.integers(-2**63, 2**63 - 1), max_size=50))
def test_filters_never_miss(held, others):
    f = X.bloom(np.array(held, np.int64))
    assert all(X.may_hold(f, np.array([k], np.int64)) for k in held)
    assert not X.may_hold(f, np.array([], np.int64))
    if not held and others:
        assert not X.may_hold(f, np.array(others, np.int64))


def test_filters_rule_out_most():
    rng = np.random.default_rng(1)
    f = X.bloom(rng.integers(-2**63, 2**63, 20_000))
    wrong = sum(X.may_hold(f, rng.integers(-2**63, 2**63, 1)) for _ in range(5000))
    assert wrong < 100


def delivery(spark, ids, tag):
    return spark.createDataFrame([(i, f"{tag}{i}") for i in ids], "id long, v string").coalesce(1)


def test_untouched_files_are_not_read(spark, tmp_path):
    plain, indexed = str(tmp_path / "a"), str(tmp_path / "b")
    hashed = [int(x) for x in np.random.default_rng(2).permutation(5000)]
    batches = [hashed[k * 500:(k + 1) * 500] for k in range(6)]  # ranges overlap: only the filters tell
    for k, ids in enumerate(batches):
        n, files = X.append_indexed(spark, delivery(spark, ids, "x"), indexed, "id")
        assert n == 500 and len(files) <= 1
        I.append_new(spark, delivery(spark, ids, "x"), plain, "id")
    # a late delivery: some of the third batch, some new ones, one of them twice
    late = batches[2][:40] + hashed[4000:4020] + hashed[4000:4001]
    n, files = X.append_indexed(spark, delivery(spark, late, "y"), indexed, "id")
    assert n == 20 == I.append_new(spark, delivery(spark, late, "y"), plain, "id")
    third = {r.f for r in spark.read.parquet(indexed).where(f"id = {batches[2][0]}").selectExpr("_metadata.file_path f").collect()}
    assert len(files) <= 2 and third <= {f.replace("file:///", "file:/") for f in files} | set(files)
    # a replay
    assert X.append_indexed(spark, delivery(spark, late, "y"), indexed, "id")[0] == 0
    a, b = (sorted(map(tuple, spark.read.parquet(p).collect())) for p in (plain, indexed))
    assert a == b and len(a) == 3020


def test_files_behind_the_index_are_caught_up(spark, tmp_path):
    path = str(tmp_path / "t")
    X.append_indexed(spark, delivery(spark, range(10), "x"), path, "id")
    delivery(spark, range(10, 20), "x").write.mode("append").parquet(path)  # by another job
    assert X.append_indexed(spark, delivery(spark, range(5, 25), "x"), path, "id")[0] == 5
    assert spark.read.parquet(path).count() == 25 and X.refresh_index(spark, path, "id") == 0


@pytest.mark.parametrize("most", [X.MAX_KEYS, 0])
def test_string_keys_and_large_deliveries(spark, tmp_path, monkeypatch, most):
    path = str(tmp_path / "t")
    rows = lambda ids: spark.createDataFrame([(f"k{i}", i) for i in ids] + [(None, 1)], "id string, v long").coalesce(1)
    X.append_indexed(spark, rows(range(100, 200)), path, "id")
    X.append_indexed(spark, rows(range(300, 400)), path, "id")
    files = X.files_that_may_hold(spark, rows(range(310, 320)), "id", path, most)
    assert len(files) == 1
    assert X.files_that_may_hold(spark, rows([]), "id", path) == []
    assert X.append_indexed(spark, rows(range(350, 450)), path, "id")[0] == 50
