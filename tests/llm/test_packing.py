"""Packing: best fit against a plain search, exact round trips."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tabkit.llm import packing as K
from tabkit.llm.queries import all_queries


def plain_best_fit(lengths, capacity):
    """Free space of the rows, by looking at all of them for every piece."""
    spaces = []
    for n in sorted(lengths, reverse=True):
        fits = [s for s in spaces if s >= n]
        if fits:
            spaces[spaces.index(min(fits))] -= n
        else:
            spaces.append(capacity - n)
    return sorted(spaces)


def test_best_fit_is_the_plain_one():
    rng = random.Random(2)
    for capacity in (1, 2, 7, 16, 100, 2048):
        for _ in range(30):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(120))]
            placed, rows = K.best_fit_decreasing(lengths, capacity)
            used = [0] * rows
            taken = set()
            for (row, at), n in zip(placed, lengths):
                used[row] += n
                cells = {(row, c) for c in range(at, at + n)}
                assert not taken & cells and at + n <= capacity
                taken |= cells
            assert sorted(capacity - u for u in used) == plain_best_fit(lengths, capacity)


def check_rows(rows, capacity, pad):
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(positions) == capacity and r.cu_seqlens[0] == 0
        assert len(r.cu_seqlens) - 1 == len(r.doc_ids) == len(r.starts) > 0
        want = np.concatenate([np.arange(b - a) for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:])])
        assert (positions[:len(want)] == want).all() and not positions[len(want):].any()
        assert (ids[len(want):] == pad).all()


def test_query_round_trip(spark, sf_dir):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    packed = all_queries()["op4_packed_rows"].build(spark, sf_dir)
    rows = packed.collect()
    check_rows(rows, 2048, 50256)
    back = {r.doc_id: list(r.ids) for r in K.documents_of(packed).collect()}
    assert back == {i: ids for i, t in texts.items() if (ids := enc.encode_ordinary(t))}
    total = sum(map(len, back.values()))
    assert sum(r.cu_seqlens[-1] for r in rows) == total
    assert len(rows) <= 1.05 * total / 2048 + 8  # nearly full; a rest per partition


@pytest.mark.parametrize("window", [1, 50, 10**6])
def test_odd_rows(spark, window):
    data = [(1, None, "k"), (2, [], "k"), (3, list(range(25)), "k"), (4, [7] * 10, "k"), (4, [7] * 10, "k"), (None, [1, 2], "k"),
            (6, [65535], "k"), (7, list(range(10)), "k")]
    df = spark.createDataFrame(data, "doc_id long, ids array<int>, starts string")
    packed = K.pack(df, capacity=10, pad=9, window=window)
    check_rows(packed.collect(), 10, 9)
    got = sorted((r.doc_id or 0, r.start, list(r.ids)) for r in K.unpack(packed).collect())
    assert got == [(0, 0, [1, 2]), (3, 0, list(range(10))), (3, 10, list(range(10, 20))), (3, 20, list(range(20, 25))),
                   (4, 0, [7] * 10), (4, 0, [7] * 10), (6, 0, [65535]), (7, 0, list(range(10)))]
    assert K.pack(df.limit(0), capacity=10).count() == 0
    with pytest.raises(Exception):
        K.pack(df.selectExpr("doc_id", "array(70000) ids"), capacity=10).collect()
    with pytest.raises(ValueError):
        K.pack(df, capacity=0)
