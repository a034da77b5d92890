"""Importance resampling: hashes against zlib, whole results against a plain
version, odd input."""

import math
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabkit.llm import resampling as R
from tabkit.llm.queries import all_queries
from tabkit.sources.tables import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode("utf-8", "surrogatepass"))
                        for i in range(len(words)) for k in range(1, longest + 1) if i + k <= len(words)]


def brute(docs, target, share=(5, 100), buckets=10000):
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for hist, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for f in features(x)[1]:
                hist[f % buckets] += 1
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((b + 1) * (S + buckets) / ((a + 1) * (T + buckets))))
            for a, b in zip(s.tolist(), t.tolist())]
    out = {}
    for i, x in docs:
        n, f = features(x)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[v % buckets] for v in f)
        out[i] = [n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((i for i in out if out[i][0] >= 20), key=lambda i: (-out[i][3], i))
    for k, i in enumerate(able[:len(able) * share[0] // share[1]]):
        out[i][4] = k + 1
    return {i: tuple(v[1:]) for i, v in out.items()}


ODD = [None, "", " ", "\n\n", "A", "Zé ß漢字 x\x00y A-B c", "a" * 5000 + " b " + "c" * 40, "x " * 20000, "ÄÖ İI",
       "'quoted', words: 12-34", "\x7f{}~[a]"]


@pytest.mark.parametrize("text", ODD)
def test_windows_of_odd_texts(text):
    n, m, found = R.WindowHasher(10000, 3).windows([text, "tail of words"])
    want_n, want = features(text)
    assert (n[0], m[0]) == (want_n, len(want))
    assert found[:m[0]].tolist() == [v % 10000 for v in want]
    assert found[m[0]:].tolist() == [v % 10000 for v in features("tail of words")[1]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB é漢-\x00\n0", max_size=120), max_size=5), st.integers(1, 5))
def test_windows_of_any_texts(texts, longest):
    _, m, found = R.WindowHasher(70000, longest).windows(texts)
    want = [features(t, longest)[1] for t in texts]
    assert m.tolist() == list(map(len, want))
    assert found.tolist() == [v % 70000 for w in want for v in w]


def test_checksums_of_long_parts():
    rng = np.random.default_rng(1)
    for size in (0, 1, 31, 32, 33, 255, 100_000):
        a, b = rng.bytes(50), rng.bytes(size)
        got = R.appended(np.array([zlib.crc32(a)], np.uint32), np.array([size]))[0] ^ zlib.crc32(b)
        assert got == zlib.crc32(a + b)


def test_the_query_equals_a_plain_version(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, sf_dir, "benchmark").select("text").collect()]
    got = all_queries()["op11_importance_resampling"].build(spark, sf_dir)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == brute(docs, target)


def test_odd_rows(spark):
    texts = [(i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts], "doc_id bigint, text string, source string")
    target = spark.createDataFrame([("x x y",), (None,)], "text string")
    got = R.resample(docs, target, share=(1, 1)).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == brute(texts, ["x x y", None], (1, 1))
    assert all(r.source == "s" for r in got)


def test_ties_repeated_rows_and_null_ids(spark):
    text = "w " * 30
    docs = spark.createDataFrame([(7, text)] * 5 + [(None, text)] * 3, "doc_id bigint, text string")
    got = R.resample(docs, docs.limit(0), share=(1, 1)).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 9))
    assert len({r.score for r in got}) == 2


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert R.resample(none, none).collect() == []
    with pytest.raises(ValueError):
        R.resample(none.withColumn("weight", F.lit(1)), none)
