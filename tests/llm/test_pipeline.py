"""The pipeline against a plain version of its stages."""

from collections import Counter

import base64

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tabkit.llm import mixing, quality
from brute_force import brute

from pyspark.sql import functions as F


def test_pipeline_stage_by_stage(spark, sf_dir):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(corpus_pipeline.RANKS), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    # quality: the model's verdict, taken row by row
    model = quality.fit(quality.counts_frame(docs))
    judged = quality.judge(quality.counts_frame(docs), model).collect()
    kept = {r.doc_id for r in judged if r.kept}
    first = corpus_pipeline.reject_low_quality(spark, docs, sf_dir)
    assert first.columns == docs.columns
    assert {r.doc_id for r in first.collect()} == kept and kept
    # near duplicates: all pairs on full sets
    found = brute([(i, rows[i].text) for i in kept], 5, 80, 100)
    ones = {i for i, (_, root) in found.items() if root == i}
    second = corpus_pipeline.drop_near_duplicates(spark, first, sf_dir)
    assert second.columns == docs.columns
    assert sorted(r.doc_id for r in second.collect()) == sorted(ones)
    assert len(ones) < len(kept)
    # mixing: the planned copies of each row
    plan = mixing.systematic_copies(second.withColumn("size", mixing.word_count()), "size").collect()
    third = corpus_pipeline.mix_sources(spark, second, sf_dir)
    assert third.columns == docs.columns
    copies = Counter(r.doc_id for r in third.collect())
    assert copies == Counter({r.doc_id: r.copies for r in plan if r.copies})
    # tokens
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in out) == copies
    for r in out:
        assert r.round_trip and list(r.ids) == enc.encode_ordinary(rows[r.doc_id].text) and r.n_tokens == len(r.ids)


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{i}" for i in range(60)) + "."
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "a", 0), (2, text, "en", None, 1),
                                 (2, text, "en", None, 1), (3, text, "en", "b", 1)], schema)
    for df in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, "")
            df.count()


def test_stages_take_columns_with_their_inner_names(spark, sf_dir):
    from tabkit.llm import mixing, near_dups, quality
    names = ["n_words", "kept", "p_good", "base_failed", "_text", "_packed", "_id", "_hash", "_row", "_size", "size", "copies",
             "target", "source_size"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    wide = docs.select("*", *(F.lit(n).alias(n) for n in names)).cache()
    for stage in (quality.keep_good, near_dups.keep_one, mixing.mix):
        out = stage(wide)
        assert out.columns == wide.columns
        rows = out.collect()
        assert rows and all(r[n] == n for r in rows for n in names)
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stage(docs).collect())
