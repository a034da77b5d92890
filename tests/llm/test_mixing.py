"""Systematic mixing: oracle parity, a plain water-filling loop, bounds."""

import math
from collections import Counter, defaultdict

import pytest

from tabkit.llm import mixing as M
from tabkit.llm.queries import all_queries
from tabkit.plans.check import compare, duckdb_conn


def fill(sizes, weights=(5, 2, 1)):
    """Targets by sharing the excess again until nobody is above the cap."""
    keys = sorted(sizes, key=lambda k: (k is None, k or ""))
    weight = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    full, left = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [k for k in keys if k not in full]
        give = {k: left * weight[k] / sum(weight[j] for j in rest) for k in rest}
        over = [k for k in rest if give[k] > 2 * sizes[k]]
        if not over:
            return {**full, **give}
        for k in over:
            full[k] = 2.0 * sizes[k]
            left -= full[k]


def test_query_matches_oracle(spark, sf_dir):
    con = duckdb_conn(sf_dir)
    assert compare(spark, con, all_queries()["op8_systematic_mix"], sf_dir)["status"] == "ok"
    con.close()


def test_query_against_plain_filling(spark, sf_dir):
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = all_queries()["op8_systematic_mix"].build(spark, sf_dir).collect()
    sizes, taken, target, most = Counter(), Counter(), {}, Counter()
    for r in rows:
        k = source[r.doc_id]
        sizes[k] += r.size
        taken[k] += r.taken
        target[k] = r.target
        most[k] = max(most[k], r.size)
        assert r.taken <= 2 * r.size
    want = fill(sizes)
    for k in sizes:
        assert target[k] == pytest.approx(want[k], rel=1e-9)
        assert abs(taken[k] - target[k]) <= 2 * most[k]


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, Extra string")


def test_copies_follow_the_running_sum(spark):
    rows = [(i, s, "w " * (1 + i * 7 % 30), "e") for i in range(600)
            for s in ("a", "b", None, "é")[:1 + i % 4]] + [(None, "a", None, None)] * 3 + [(5, "zero", "", "x")]
    df = make(spark, rows).withColumn("size", M.word_count())
    out = M.systematic_copies(df, "size").collect()
    assert len(out) == len(rows)
    n, copies, size, target = Counter(), Counter(), {}, {}
    per_row = defaultdict(set)
    for r in out:
        n[r.source] += 1
        copies[r.source] += r.copies
        size[r.source], target[r.source] = r.source_size, r.target
        per_row[r.source].add(r.copies)
    for k in n:
        ratio = target[k] / size[k] if size[k] else 0
        assert abs(copies[k] - ratio * n[k]) < 1
        assert per_row[k] <= {math.floor(ratio), math.ceil(ratio)}
    assert {k: target[k] for k in n} == pytest.approx(fill(size))


def test_mix_emits_copies_and_reruns_agree(spark):
    df = make(spark, [(i, "ab"[i % 2], "x y z", str(i)) for i in range(100)] + [(1, "b", "x y z", "1")] * 5)
    one = Counter(M.mix(df).collect())
    assert one == Counter(M.mix(df.repartition(7)).collect())
    assert M.mix(df).columns == df.columns
    planned = M.systematic_copies(df.withColumn("size", M.word_count()), "size").groupBy().sum("copies").first()[0]
    assert sum(one.values()) == planned


def test_empty_and_clashes(spark):
    empty = make(spark, []).withColumn("size", M.word_count())
    assert M.systematic_copies(empty, "size").count() == 0
    assert M.mix(make(spark, [(1, None, None, None)])).count() == 0
    with pytest.raises(ValueError):
        M.systematic_copies(empty.withColumnRenamed("Extra", "COPIES"), "size")
