"""Near duplicates against all pairs on full sets."""

import random

import numpy as np
import pytest

from tabkit.llm import near_dups as N
from tabkit.llm.queries import all_queries

from brute_force import brute, shingles

def test_query_against_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(rows, 3, 85, 100)
    got = all_queries()["op6_lsh_forest"].build(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def planted(n=260, seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rng.choices(vocab, k=120) for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words).replace("w1", "W1")))
    return rows + [(n, None), (n + 1, ""), (n + 2, "a b"), (n + 3, "A  b"), (n + 4, "a b c"), (n + 5, " \n")]


@pytest.mark.parametrize("region,block", [(1000, 3000), (8, 10)])
def test_planted_groups_with_small_bounds(spark, monkeypatch, region, block):
    """Tiny bounds force deeper prefixes, several blocks and the exact pass
    over what lies outside the largest component."""
    monkeypatch.setattr(N, "REGION", region)
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    monkeypatch.setattr(N, "SHARED_ROWS", 2)
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", N.F.lit("x"))
    got = N.near_duplicates(df, width=3, threshold=(85, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 3, 85, 100)


def test_neighbours_in_one_large_region_all_meet(spark, monkeypatch):
    """All documents lie in the same region of every tree and no two share a
    longer prefix; each of the linked pairs is found all the same."""
    monkeypatch.setattr(N, "REGION", 4)
    depth = N.start_depth(0.8)
    rows, signed = [], []
    rng = np.random.default_rng(4)
    for pair in range(60):
        like = rng.integers(0, 256, (N.TREES, N.DEPTH), dtype=np.uint8)
        for k in (0, 1):
            doc = 2 * pair + k
            text = " ".join([f"p{pair}x{j}" for j in range(50)] + [f"d{doc}"])
            like[:, depth] = doc
            shingles = N.shingle_sets([text], 1)[0]
            rows.append((doc, text))
            signed.append((doc, text, len(shingles), bytearray(N.set_name(shingles)), bytearray(like.tobytes()),
                           list(range(N.TREES))))
    made = spark.createDataFrame(signed, "doc_id long, text string, n_shingles long, node binary, bits binary, regions array<long>")
    monkeypatch.setattr(N, "signatures", lambda docs, width, depth: made.withColumn("text_hash", N.F.xxhash64("text")))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.near_duplicates(df, width=1, threshold=(80, 100)).collect()}
    assert got == {doc: doc // 2 * 2 for doc, _ in rows}


def test_sets_are_those_of_the_definition():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbB \t\n\x0b\x1c é") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [None, "x" * 200_000, "a " * 5000, "É é"]
    for width in (3, 5):
        want = [shingles(t, width) for t in texts]
        got = N.shingle_sets(texts, width)
        assert [len(s) for s in got] == [len(s) for s in want]
        for i in range(0, 300, 7):
            for j in range(300):
                assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_nulls_repeats_empty(spark):
    t = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(7, t, "a"), (7, t, "a"), (3, t + " x", "b"), (None, t, "c"), (None, "q r s t u v", "d"),
                                (9, None, "e")], "doc_id long, text string, kept string")
    rows = N.near_duplicates(df).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [
        (-1, -1, True), (-1, 3, False), (3, 3, True), (7, 3, False), (7, 3, False), (9, 9, True)]
    assert sorted(r.kept for r in N.keep_one(df).collect()) == ["b", "d", "e"]
    assert N.keep_one(df).columns == df.columns
    assert N.near_duplicates(df.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Copies without ids, rows delivered many times with one id, and both
    next to a near copy."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(50)) for x in "abcd")
    rows = ([(None, a, "copy")] * 3 + [(None, a + " x", "near")] + [(5, b, "again")] * 4 + [(5, b + " x", "same id")]
            + [(6, c, "c"), (None, c, "c"), (8, d, "d1"), (8, d, "d2"), (None, None, "e"), (None, None, "e")])
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    kept = N.keep_one(df).collect()
    groups = sorted((r.text or "-")[0] for r in kept)
    assert groups == ["-", "-", "a", "b", "c", "d"]
    assert [r.doc_id for r in kept if r.tag == "c"] == [6]


def test_a_template_of_unlinked_documents(spark, monkeypatch):
    """Many documents on one template, none linked but for planted pairs: the
    longer prefixes part them, and no pair is lost."""
    monkeypatch.setattr(N, "REGION", 100)
    met, went, deeper = N.meetings, [], N.deeper_regions
    monkeypatch.setattr(N, "deeper_regions", lambda *a: went.append(a) or deeper(*a))
    monkeypatch.setattr(N, "meetings", lambda large, groups: met(large, groups) if large.agg(N.F.max("n")).first()[0] < 400
                        else pytest.fail("left to the last resort"))
    frame = " ".join(f"t{i}" for i in range(80))
    rows = [(i, frame + " " + " ".join(f"d{i // 2 if i < 20 else i}x{j}" for j in range(40)) + (" z" if i < 20 and i % 2 else ""))
            for i in range(600)]
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3).collect()}
    assert got == {i: i // 2 * 2 if i < 20 else i for i in range(600)}
    assert went  # to longer prefixes


def test_misses_stay_below_the_bound():
    for t in (0.8, 0.85):
        for depth in N.DEEPER:
            n = N.trees_for(depth, t)
            assert (1 - t ** depth) ** n <= N.MISS < (1 - t ** depth) ** (n - 1)


def test_repeated_rows_reach_a_block_once_per_partition(spark):
    a, b = (" ".join(f"a{i}" for i in range(50)) + x for x in ("", " x"))
    df = spark.createDataFrame([(5, a)] * 4000 + [(9, b)], "doc_id long, text string").repartition(4)
    docs = df.withColumn("text_hash", N.F.xxhash64("text"))
    keys = docs.distinct().select("doc_id", "text_hash", N.F.lit(1).cast("bigint").alias("block"))
    assert N.texts_of(docs, keys, "block").count() <= 5
    assert {r.component_id for r in N.near_duplicates(df).collect()} == {5}


@pytest.mark.parametrize("few", [0, 300_000])
def test_components_of_a_graph(spark, monkeypatch, few):
    """Paths, stars, a tangle, loops and repeated edges: each node but the
    roots once, with the smallest node that it reaches; joined by key as well
    as broadcast."""
    monkeypatch.setattr(N, "BROADCAST_ROWS", few)
    rng = random.Random(3)
    name = [bytes(rng.randrange(256) for _ in range(4)) for _ in range(200)]
    links = ([(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 90)] + [(99, i) for i in range(91, 99)]
             + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(110)] + [(120, 120)]) * 2
    least = list(range(200))
    for _ in range(200):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b], key=lambda x: name[x])
    made = spark.createDataFrame([(name[a], name[b]) for a, b in links], "u binary, v binary")
    got = [(bytes(r.u), bytes(r.v)) for r in N.stars(made).collect()]
    assert sorted(got) == sorted((name[i], name[least[i]]) for i in range(200) if least[i] != i)
    assert N.stars(made.limit(0)).count() == 0


def test_small_graphs_take_few_exchanges(spark):
    """A graph that is settled takes no round, and the joins of a small one are broadcast."""
    made, seen = spark.createDataFrame([(bytes([i]), bytes([i // 10])) for i in range(10, 90)], "u binary, v binary"), []
    kept = N.materialize
    N.materialize = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df)
    try:
        N.stars(made.where("u < X'0A' or v > X'00'"))
        # nodes 1 to 8 are roots
        assert len(seen) == 1
        N.stars(made.unionByName(spark.createDataFrame([(b"\x0b", b"\x05")], made.schema)))
    finally:
        N.materialize = kept
    assert len(seen) > 2 and not any("SortMergeJoin" in plan for plan in seen)
