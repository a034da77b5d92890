"""Counts against the tokenizers library's unigram model."""

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from tabkit.llm import token_counts as C
from tabkit.llm.queries import all_queries

PATH = P.path("piece_bpe_32k.model")
_BOTH = []


def both():
    if not _BOTH:
        sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
        vocab = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.vocab_size())]
        # unknown, control and byte pieces keep their ids but cannot be in a text of the tests
        _BOTH.extend([C.UnigramCounter(C.read_pieces(PATH)), Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))])
    return _BOTH


def reference(tokenizer, text):
    if not text:
        return 0, 0
    tokens = tokenizer.encode(C.MARK + text.replace(" ", C.MARK), add_special_tokens=False).tokens
    return len(tokens), sum(t.startswith("<0x") for t in tokens)


ODD = ["", " ", "  ", "a", "hello world", "  two  spaces ", "tabs\tand\nnew\r\nlines\n\n", "ñandú 漢字 🙂🙂🏽", "x" * 3000, " " * 200,
       "ab" * 1500, "\x00\x01", "▁literal ▁▁ marks", "éèê" * 50, "1234567890 " * 40, "aaaaabaaaab" * 99]


def test_odd_texts():
    counter, tokenizer = both()
    for text in ODD:
        assert counter.count(text)[:2] == reference(tokenizer, text), text[:50]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abcdetion sh\n.,▁é漢", max_size=120)))
def test_any_text(text):
    counter, tokenizer = both()
    if "<" not in text:
        assert counter.count(text)[:2] == reference(tokenizer, text)


def test_ties_and_scores_on_a_small_vocabulary():
    pieces = [("a", -2.0), ("b", -2.0), ("aa", -4.0), ("ab", -3.0), ("aab", -6.0), ("ba", -3.0), ("▁", -1.0), ("▁a", -3.0)]
    vocab = [("<unk>", 0.0)] + pieces + [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    counter, tokenizer = C.UnigramCounter(pieces), Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    import itertools
    for n in range(1, 8):
        for text in map("".join, itertools.product("ab c", repeat=n) if n < 6 else itertools.product("ab ", repeat=n)):
            assert counter.count(text)[:2] == reference(tokenizer, text), text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdetionsh.,▁é", max_size=80))
def test_parts_of_plain_characters_take_the_short_way(text):
    """What the short way finds is what the general one finds, score and all."""
    counter, _ = both()
    if text:
        assert counter.single.issuperset(text)
        assert counter._plain(text) == counter._any(text) == counter.count_part(text)


def test_parts_are_remembered():
    counter = C.UnigramCounter(C.read_pieces(PATH))
    made = []
    counter._part.make = lambda part: made.append(part) or counter.count_part(part)
    words = [f"{i:06d}" for i in range(120_000)]
    for _ in range(2):
        counter.count(" ".join(words))
    assert len(made) == len(words)  # none was counted twice
    long = "x" * (C.MEMO_PART + 1)
    assert counter.count(long) == counter.count(long) and made[-1] == C.MARK + long and C.MARK + long not in counter._part


def test_query(spark, sf_dir):
    counter, tokenizer = both()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = all_queries()["op5_unigram_counts"].build(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    score = dict(C.read_pieces(PATH))
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_tokens, r.n_fallback_bytes) == reference(tokenizer, text)
        tokens = tokenizer.encode(C.MARK + text.replace(" ", C.MARK)).tokens if text else []
        if not r.n_fallback_bytes:
            assert r.score == sum(score[t] for t in tokens)


def test_nulls_repeats_empty_and_clashes(spark):
    df = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (None, "a b", None), (2, "", "z")], "doc_id long, text string, Score_ string")
    out = C.count_tokens(df, PATH)
    assert sorted((r.doc_id or 0, r.n_tokens, r.score != 0) for r in out.collect()) == [(0, 2, True), (1, 0, False), (1, 0, False), (2, 0, False)]
    assert C.count_tokens(df.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        C.count_tokens(df.withColumnRenamed("Score_", "SCORE"), PATH)
