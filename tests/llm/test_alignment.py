"""Two tokenizers aligned: against a plain version, and odd input."""

import json
from collections import defaultdict
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tabkit.llm import alignment as A
from tabkit.llm.queries import all_queries
from tabkit.sources.tables import table

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokenizers():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    chars = A.byte_of_character()
    entry = {i: bytes(chars[c] for c in t) for t, i in json.load(open(A_PATH))["model"]["vocab"].items() if i != 50256}
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def both(text):
        if not text:
            return [], []
        raw = b" " + text.encode()
        x = [(i, entry[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])

    return both


def brute(rows):
    both, docs, held = tokenizers(), [], defaultdict(set)
    for k, (i, text) in enumerate(rows):
        x, y = both(text)
        spans = []
        for side in (x, y):
            at, out = 0, []
            for number, raw in side:
                out.append((number, at, at + len(raw)))
                at += len(raw)
            spans.append(out)
        links = [(p[0], q[0]) for p in spans[0] for q in spans[1] if p[1] < q[2] and q[1] < p[2]]
        common = sorted({p[2] for p in spans[0]} & {q[2] for q in spans[1]})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(t[0]) for t in side if start < t[2] <= end) for side in spans))
            start = end
        for pair in links:
            held[pair].add(k)
        docs.append((i, len(x), len(y), len(groups), links, sha256(";".join(groups).encode()).hexdigest() if x else ""))
    top = defaultdict(int)
    for (p, q), d in held.items():
        top[p] = max(top[p], len(d))
    return sorted(((i, a, b, g, len(links), sum(len(held[x]) == top[x[0]] for x in links),
                    sum(len(held[x]) for x in links), h) for i, a, b, g, links, h in docs), key=repr)


ODD = [None, "", " ", "a", "  two  spaces", "é ß 漢字 　 ﬁ", "<|endoftext|> </s> <unk>", "tab\tline\nend ", "x" * 300,
       "ééééé ééé", "don't 12345 don't", "a\x00b", "▁ mark", "naïve co-operation — «ok»"]


@pytest.mark.parametrize("hot", [1, 40, 500_000])
def test_odd_rows(spark, hot):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (None, "a word and a word"), (None, "a word and a word")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, pairs int").repartition(3)
    got = A.align(df, A_PATH, B_PATH, hot_pairs=hot)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_the_query_equals_a_plain_version(spark, sf_dir):
    short = table(spark, sf_dir, "documents").where("n_chars < 1500").select("doc_id", "text")
    got = A.align(short, A_PATH, B_PATH, hot_pairs=200)
    assert sorted(map(tuple, got.collect()), key=repr) == brute([tuple(r) for r in short.collect()])
    whole = all_queries()["op13_tokenizer_alignment"].build(spark, sf_dir)
    assert whole.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert whole.count() == table(spark, sf_dir, "documents").count()


def test_a_long_text(spark):
    df = spark.createDataFrame([(1, "some words, again and again. " * 20000)], "doc_id bigint, text string")
    r = A.align(df, A_PATH, B_PATH).first()
    assert r.n_links >= max(r.n_a, r.n_b) > 100_000 and r.n_best > 0 and r.count_sum == r.n_links


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert A.align(none, A_PATH, B_PATH).collect() == []


def test_identity_map_prefers_pieces_to_bytes():
    assert A.identity_map([b"a", b"b", b"c"], [b"a", b"", b"a", b"b"], frozenset({0})).tolist() == [2, 3, -1]
