"""Quality votes: counts against a brute-force version, expectation-
maximisation on planted votes, held-out agreement with labels."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabkit.llm import quality as Q
from tabkit.llm.queries import all_queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            inside.update(range(i, i + 8))
    lines, dup = text.split("\n"), 0
    for i, line in enumerate(lines):
        dup += bool(WORD.search(line)) and line in lines[:i]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


ODD = [None, "", " ", "\n\n", "a", "a b c d e f g h a b c d e f g h", "x\nx\n x\n\n\n", "x " * 3000,
       "# | <>\n# | <>", "é ß 漢 字　\x1c \x0b\x0c", "a b " * 20 + "c d", "w\ud800x y"]


@pytest.mark.parametrize("text", ODD)
def test_counts_of_odd_texts(text):
    if text is not None and len(text) > 1000:
        assert Q.measure(text)[:5] == (3000, 3000, 0, 0, 3000)
    else:
        assert Q.measure(text)[:5] == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab|\n  #", max_size=150))
def test_counts_of_any_text(text):
    assert Q.measure(text)[:5] == brute(text)


def test_planted_votes_are_recovered():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.85
    rules = tuple(Q.Rule(f"r{i}", "k", "", "") for i in range(6))
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.95])
    votes = np.where(rng.random((20000, 6)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.3] = Q.NONE
    patterns, counts = np.unique(votes @ 3 ** np.arange(5, -1, -1), return_counts=True)
    model = Q.fit_votes(patterns, counts.astype(float), rules)
    assert abs(model.priors[0] - 0.85) < 0.03
    assert np.abs(model.accuracies() - right).max() < 0.03
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.97


def test_query_against_brute_force_and_labels(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = all_queries()["op10_quality_votes"].build(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    kept, votes = {}, {}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
        kept[r.doc_id], votes[r.doc_id] = r.kept, r.base_failed
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.doc_id in kept]
    good = [kept[r.doc_id] for r in labels if r.quality == 1 and not votes[r.doc_id]]
    bad = [kept[r.doc_id] for r in labels if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_posterior_in_spark_equals_numpy(spark, sf_dir):
    counts = Q.counts_frame(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    model = Q.fit(counts)
    for r in Q.judge(counts, model).limit(50).collect():
        c = dict(zip(Q.COUNTS, Q.measure(r.text)))
        votes = []
        for rule in Q.RULES:
            ask = lambda e: eval(re.sub(r"(?<![<>])=", "==", e), {}, c)
            votes.append(Q.BAD if ask(rule.bad) else Q.GOOD if ask(rule.good) else Q.NONE)
        assert r.p_good == pytest.approx(model.posterior(np.array([votes]))[0], abs=1e-9)


def test_nulls_repeats_empty_and_clashes(spark):
    df = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (None, "a b", None)], "doc_id long, text string, kept_ string")
    model = Q.fit(Q.counts_frame(df))
    rows = Q.judge(Q.counts_frame(df), model).collect()
    assert len(rows) == 3 and not any(r.kept for r in rows)
    empty = df.limit(0)
    assert Q.keep_good(empty).columns == df.columns and Q.keep_good(empty).count() == 0
    with pytest.raises(ValueError):
        Q.counts_frame(df.withColumnRenamed("kept_", "n_words"))
    with pytest.raises(ValueError):
        Q.judge(Q.counts_frame(df).withColumn("KEPT", Q.F.lit(1)), model)
