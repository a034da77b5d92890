"""Log-bilinear language model: counts and base score against a plain version,
probabilities that sum to one, a gradient check, held-out gain, odd input."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabkit.llm import lm as M
from tabkit.llm.queries import all_queries
from tabkit.sources.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """id -> held out, tokens, known tokens, training tokens, base score."""
    texts = [(i, [w for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + [None]) for i, t in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(w for i, ws in texts if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n,
             round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in texts]


def shown(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in df.collect()), key=repr)


ODD = [None, "", " \n", "A a a b", "é É ß 漢字 　x", "w" * 300 + " " + "w" * 301, "word " * 3000, "a\x00b \x1c", "zz yy"]


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 3)] + [(None, "a b"), (None, "a b"), (4, "a"), (4, "a")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, score int").repartition(3)
    got = M.score(df)
    assert shown(got) == sorted(brute(rows), key=repr)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got.collect())


def test_rare_words_join_to_the_same_counts(spark, monkeypatch):
    rows = [(i, f"common words {i % 7} and word{i % 40} x{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    training = df.where(~M.is_held_out(df.doc_id))
    counts = M.word_counts(training).persist()
    results = []
    for hot in (1_000_000, 20):
        v = M.vocabulary(counts, own=3, hot_words=hot)
        assert (len(v.words) < 25) == (hot == 20)
        assert sum(v.shares) == v.tokens
        # one model for both: same own words, same classes
        model = M.new_model(v, seed=1)
        out = M.scored(df, counts, v, model)
        assert shown(out) == sorted(brute(rows), key=repr)
        results.append({r.doc_id: r.score for r in out.collect()})
    counts.unpersist()
    assert results[0].keys() == results[1].keys()
    assert all(abs(results[0][i] - results[1][i]) < 1e-3 for i in results[0])


def test_probabilities_sum_to_one():
    """Over all known words of a vocabulary and the unseen one."""
    words = [b"w%d" % i for i in range(50)] + [b"x%d" % i for i in range(50)]
    counts = np.arange(100, 0, -1)
    own, ends = 20, 10
    shares, smoothed = np.zeros(1 + own + M.CLASSES), np.ones(1 + own + M.CLASSES)
    shares[0], shares[1:1 + own] = ends, counts[:own]
    for w, n in zip(words[own:], counts[own:]):
        shares[1 + own + M.class_of(w)] += n
        smoothed[1 + own + M.class_of(w)] += n + 1
    smoothed[1 + own:] -= 1
    v = M.Vocabulary(int(counts.sum()) + ends, 101, words, counts, own, shares, smoothed)
    model = M.new_model(v, seed=3)
    model.outcome *= 8
    before = np.array([[3, 0, 25, 1]], np.int16)
    units = np.append(0, v.unit_of_hot())
    p = np.exp(model.log_probabilities(np.repeat(before, len(units), 0), units))
    share = np.append(1, np.where(np.arange(100) < own, 1.0, (counts + 1) / smoothed[v.unit_of_hot()]))
    size = v.tokens + v.distinct + 1
    assert abs((p * share * (1 - 1 / size)).sum() + 1 / size - 1) < 1e-5


def test_flat_words_are_the_words():
    long = "x" * 41
    texts = ["A b", None, "", " \n é漢 " + long, "\x00\x1c \tq\x0b" + "y" * 40, "  "]
    flat = M.Flat.of(texts)
    cut = [M.words_of(t) for t in texts]
    assert [flat.word(i) for i in range(len(flat.start))] == [w for c in cut for w in c]
    assert np.diff(flat.ends, prepend=0).tolist() == list(map(len, cut))
    words = [b"b", M.words_of(long)[0], b"a"]
    v = M.Vocabulary(9, 3, words, np.array([3, 2, 1]), 1, np.ones(2 + M.CLASSES), np.ones(2 + M.CLASSES))
    hot, units = M.Words(v).read(flat)
    assert hot.tolist() == [words.index(w) if w in words else -1 for c in cut for w in c]
    assert units.tolist() == [1 if w == b"b" else 2 + M.class_of(w) for c in cut for w in c]


def test_places_start_anew_in_each_text():
    units, before, text = M.places(np.array([5, 6, 7], np.int16), np.array([2, 2, 3]), 2)
    assert units.tolist() == [5, 6, 0, 0, 7, 0]
    assert text.tolist() == [0, 0, 0, 1, 2, 2]
    assert before.tolist() == [[0, 0], [5, 0], [6, 5], [0, 0], [0, 0], [7, 0]]


def test_contrastive_training_learns_a_planted_chain():
    """A chain in which each unit is mostly followed by the next one."""
    rng, n = np.random.default_rng(0), 20
    walk = np.zeros(60000, np.int16)
    for i in range(1, len(walk)):
        walk[i] = (walk[i - 1] + 1) % n if rng.random() < 0.9 else rng.integers(n)
    shares = np.bincount(walk, minlength=n).astype(float)
    v = M.Vocabulary(len(walk), n, [], np.zeros(0, np.int64), n - 1, shares, np.ones(n))
    trainer = M.Trainer(M.new_model(v, context=2), shares, 0.1, 7)
    before = np.stack([np.roll(walk, 1), np.roll(walk, 2)], 1)
    for at in range(0, 50000, M.BLOCK):
        trainer.block(walk[at:at + M.BLOCK], before[at:at + M.BLOCK])
    held = slice(50500, None)
    got = trainer.model.log_probabilities(before[held], walk[held]).mean()
    best = 0.905 * math.log(0.905) + 0.095 * math.log(0.005)
    assert got > math.log(1 / n) + 0.7 * (best - math.log(1 / n))


def test_held_out_texts_gain_and_reruns_agree(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = all_queries()["op12_neural_scores"].build(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = got.collect()
    assert shown(got) == sorted(brute([tuple(r) for r in docs.collect()]), key=repr)
    held = [r for r in rows if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.05
    again = {r.doc_id: r.score for r in all_queries()["op12_neural_scores"].build(spark, sf_dir).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, rel=1e-4) for r in rows)


def test_no_training_texts_and_empty_table(spark):
    lone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = M.score(spark.createDataFrame([(lone, "a b")], "doc_id bigint, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)
    assert M.score(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
