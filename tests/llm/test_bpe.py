"""Byte-level BPE against the tiktoken library and by exact round trips."""

import base64
import hashlib
import string
import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tabkit.llm import bpe
from tabkit.llm.queries import all_queries

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = P.path(request.param)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.BytePairCodec(bpe.read_ranks(path), P.PATTERN), enc


ODD = ["", " ", "  ", "\n", " \n x", "a", " a", "a ", "a  b", "don't  stop\t\tnow\r\n", "x" * 5000, " " * 300,
       "ab" * 2000, "ñandú 漢字 テスト 🙂🙂🏽 é", "1234567890" * 30, "\x1c\x1d a\x85b c　d", "=" * 999,
       "<|endoftext|> the end", "\x00\x01\x7f", "hello world", " leading", "tab\tseparated words here \n\n done"]


def back(codec, ids):
    return codec.decode(np.array(ids, np.int32), np.array([len(ids)]))[0].tobytes()


def test_matches_tiktoken_on_odd_texts(pair):
    codec, enc = pair
    for text in ODD:
        ids = codec.encode(text).tolist()
        assert ids == enc.encode_ordinary(text), text
        assert back(codec, ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="abcdetion sh\n .,'", max_size=120)))
def test_matches_tiktoken_on_any_text(text):
    codec, enc = _cached()
    ids = codec.encode(text).tolist()
    assert ids == enc.encode_ordinary(text)
    assert back(codec, ids) == text.encode()


_PAIR = []


def _cached():
    if not _PAIR:
        path = P.path(FILES[0])
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        _PAIR.extend([bpe.BytePairCodec(bpe.read_ranks(path), P.PATTERN),
                      tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})])
    return _PAIR


def test_query_matches_tiktoken(spark, sf_dir):
    _, enc = _cached()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = all_queries()["op3_byte_bpe"].build(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_nulls_repeats_empty_and_clashes(spark):
    path = P.path(FILES[0])
    df = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (None, "a b", None), (2, "", "z")],
                               "doc_id long, text string, extra string")
    out = bpe.encode(df, path, P.PATTERN)
    rows = bpe.decode(out, path, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in rows) == [(0, b"a b"), (1, b""), (1, b""), (2, b"")]
    assert {r.extra for r in rows} == {"k", None, "z"}
    given = spark.createDataFrame([(1, [64, 65]), (2, None), (3, []), (4, [66])], "k long, ids array<int>")
    assert {r.k: bytes(r.decoded) for r in bpe.decode(given, path, P.PATTERN).collect()} == {1: b"ab", 2: b"", 3: b"", 4: b"c"}
    assert bpe.encode(df.limit(0), path, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(out, path, P.PATTERN)


def test_long_pieces_take_time_in_proportion():
    """Pieces without a blank that need backtracking all along."""
    import random
    import time
    codec, enc = _cached()
    rng, times = random.Random(4), {}
    text = "".join(rng.choice("abcdefgh") for _ in range(400_000))
    for n in (50_000, 100_000, 200_000, 400_000):
        start = time.process_time()
        ids = codec.encode(text[:n])
        times[n] = time.process_time() - start
        assert codec.decode(ids, np.array([len(ids)]))[0].tobytes() == text[:n].encode()
    assert times[400_000] < 16 * times[50_000] + 1  # eight times the length
    assert codec.encode(text[:3000]).tolist() == enc.encode_ordinary(text[:3000])


def test_marks_after_words(pair):
    codec, enc = pair
    letters = ["word", "é", "ß", "漢", "ªº", "ǅ", "ʰa", "a\u0301", "٣", "x9"]
    marks = [*string.punctuation, "。", "’", "\u0301", "\x1c", "\u00a0"]
    text = " ".join(f"{w}{m} {w}{m}{m} {m}{w} {w}{m}s {w}{m}{w}" for w in letters for m in marks)
    for part in [text, *text.split(" "), "it's we'll' don't, can't. o'"]:
        for given in (part, "to " + part):
            assert codec.encode(given).tolist() == enc.encode_ordinary(given), given


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    seen = []
    make = bpe.BytePairCodec._encode_piece
    monkeypatch.setattr(bpe.BytePairCodec, "_encode_piece", lambda self, piece: seen.append(piece) or make(self, piece))
    codec = bpe.BytePairCodec(bpe.read_ranks(P.path(FILES[0])), P.PATTERN)
    codec.encode("so zyxwvu zyxwvu, zyxwvu. (zyxwvu) zyxwvu.\nzyxwvu zyxwvu?!")
    assert seen.count(" zyxwvu") == 1


def test_nothing_of_texts_outlives_a_task():
    codec, enc = _cached()
    text = "zyxwvu vwxyzab, qwertzu thertionverheit"
    for _ in range(2):
        assert codec.encode(text).tolist() == enc.encode_ordinary(text)
        assert codec._fits and codec._mended and codec._chunk and codec._piece
        codec.forget()
        for memo in (codec._fits, codec._mended, codec._chunk, codec._piece):
            assert not memo and not memo.older


def test_decoding_takes_little_memory_beside_its_result():
    table = bpe.TokenBytes(bpe.read_ranks(P.path(FILES[0])))
    ids = np.tile(np.arange(50_000, dtype=np.int32), 20)
    ends = np.array([0, 10, 10, len(ids)])
    size = sum(map(len, bpe.read_tokens(bpe.read_ranks(P.path(FILES[0])))))
    tracemalloc.start()
    held = pa.total_allocated_bytes()
    data, at = table.decode(ids, ends)
    used = pa.total_allocated_bytes() - held + tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert at[0] == 0 and at[1] == at[2] and at[3] == len(data) > size
    assert used < 4 * len(data)
    with pytest.raises(ValueError):
        table.decode(np.array([0, 10**6], np.int32), np.array([2]))
    with pytest.raises(ValueError):
        table.decode(np.array([0, -1], np.int32), np.array([2]))
    assert table.decode(np.zeros(0, np.int32), np.array([0, 0]))[1].tolist() == [0, 0]


def test_ids_that_the_vocabulary_lacks():
    table = bpe.TokenBytes(b"YQ== 0\nYg== 2\n")
    assert table.decode(np.array([0, 2, 0], np.int32), np.array([1, 3]))[0].tobytes() == b"aba"
    with pytest.raises(ValueError):
        table.decode(np.array([0, 1], np.int32), np.array([2]))


def test_line_ends_between_words(pair):
    codec, enc = pair
    ends = ["\n", "\n\n", "\n\n\n", " \n", "\n ", "\r\n", "\n\t", "\t\n", "\n\x1c", "\n\u00a0", ".\n(", ",\n'"]
    for text in [f"{a}{end}{b}" for end in ends for a in ("to word", "x9.", "") for b in ("Next line", "'s", "\u0301", "")]:
        assert codec.encode(text).tolist() == enc.encode_ordinary(text), text
    text = " ".join(f"a{end}b" for end in ends)
    assert codec.encode(text).tolist() == enc.encode_ordinary(text)


def test_words_whose_longest_matches_do_not_hold(pair):
    import random
    codec, enc = pair
    rng = random.Random(5)
    parts = ["th", "er", "ing", "tion", "ver", "heit", "ß", "ñ", "ción", "z", "q", "漢"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(3000)]
    assert codec.encode(" ".join(words)).tolist() == enc.encode_ordinary(" ".join(words))
    assert codec._mended  # borders that did not hold
    assert codec.encode("".join(words)).tolist() == enc.encode_ordinary("".join(words))


def test_memos_stay_bounded(monkeypatch):
    """With memos of a few entries: the same ids, no memo above its bound."""
    for name in ("MEMO_CHUNKS", "MEMO_PIECES", "MEMO_FITS", "MEMO_MENDED"):
        monkeypatch.setattr(bpe, name, 3)
    codec = bpe.BytePairCodec(bpe.read_ranks(P.path(FILES[0])), P.PATTERN)
    text = "verheiting thertion, ingver.\nzerq tionheit verzing qerth thverer, erction ingheitz" * 3
    assert codec.encode(text).tolist() == _cached()[1].encode_ordinary(text)
    for memo in (codec._chunk, codec._piece, codec._fits, codec._mended):
        assert len(memo) <= 3 and len(memo.older) <= 3


def test_batches_are_bounded_in_bytes(spark):
    """A batch of texts does not hold a whole partition (it was up to 64 MB,
    in every Python worker of a task)."""
    from tabkit.session import BATCH_KEY

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    df = spark.range(5000, numPartitions=1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
    was = spark.conf.get(BATCH_KEY, None)
    try:
        for make in (lambda: bpe.encode(df, P.path(FILES[0]), P.PATTERN), lambda: bpe.decode(df.selectExpr("array(1) AS ids"), P.path(FILES[0]), P.PATTERN)):
            spark.conf.unset(BATCH_KEY)
            make()
            assert max(r.n for r in df.mapInArrow(sizes, "n long").collect()) < 4_000_000
        spark.conf.set(BATCH_KEY, "8m")  # a bound of the session's own stays
        make()
        assert spark.conf.get(BATCH_KEY) == "8m"
    finally:
        spark.conf.unset(BATCH_KEY) if was is None else spark.conf.set(BATCH_KEY, was)
