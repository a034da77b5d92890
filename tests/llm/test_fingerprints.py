"""Fingerprints against a plain version of the definition."""

import hashlib
import math

import pytest
import xxhash

from tabkit.llm import fingerprints as H
from tabkit.llm.queries import all_queries


def xx(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(4 if -2**31 <= v < 2**31 else 8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def vector(text):
    exact, sketch = [0] * 8, [0] * 128
    for paragraph in (text or "").split("\n"):
        for j in range(8):
            exact[j] = (exact[j] + (xx(paragraph, j) & 0xFFFFFFFF)) % 2**32
        words = paragraph.split(" ")
        for i in range(max(1, len(words) - 1)):
            h = xx(*words[i:i + 2])
            sketch[h % 128] += 1 - 2 * (h >> 40 & 1)
    return exact, [s % 2**32 for s in sketch], sketch


def text_of(v):
    return "".join(f"{x:08X}" for x in v[0]) + ":" + "".join(f"{s:08X}" for s in v[1])


def like(a, b):
    if a[0] == b[0]:
        return 1.0
    dot = lambda x, y: sum(p * q for p, q in zip(x[2], y[2]))
    norm = math.sqrt(dot(a, a) * dot(b, b))
    return min(1.0, max(0.0, dot(a, b) / norm)) if norm else 0.0


def expected(rows):
    """Rows (doc_id, text) in the order that decides who comes next."""
    out = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        v, e, n = vector(text), vector(edited), vector(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(v), text_of(e), like(v, e), like(v, n)))
    return out


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], abs=1e-9)


def test_query(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(H, "RANGE_ROWS", 30)
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = all_queries()["op1_multiset_hash"].build(spark, sf_dir).collect()
    compare(got, expected(rows))
    assert sum(r.near_edited for r in got) / len(got) > 0.6
    assert sum(r.near_next for r in got) / len(got) < 0.2


ODD = [(1, "a b c\n\nd e"), (2, None), (3, ""), (4, "\n"), (5, "ñandú 漢字 🙂" * 40), (7, "x"), (9, "w " * 4000), (12, "a\nb\nc\nd"),
       (10**15, "p q\nr s\nt u\nv w x y z")]


@pytest.mark.parametrize("range_rows", [1, 2, 1000])
def test_odd_rows(spark, monkeypatch, range_rows):
    monkeypatch.setattr(H, "RANGE_ROWS", range_rows)
    df = spark.createDataFrame([(*r, "k") for r in ODD], "doc_id long, text string, fingerprint string").repartition(4)
    compare(H.edited_fingerprints(df).collect(), expected(ODD))
    compare(H.edited_fingerprints(df.where("doc_id = 5")).collect(), expected([ODD[4]]))
    assert H.edited_fingerprints(df.limit(0)).count() == 0


def test_repeats_and_null_ids(spark):
    same = spark.createDataFrame([(4, "t u v w x y")] * 3 + [(None, "n o p")] * 2, "doc_id long, text string")
    got = H.edited_fingerprints(same).collect()
    compare(got, expected([(4, "t u v w x y")] * 3 + [(None, "n o p")] * 2))


def test_order_of_paragraphs_does_not_matter(spark):
    df = spark.createDataFrame([(1, "a b\nc d\ne"), (2, "e\na b\nc d"), (3, "a b\nc d"), (4, "a b\nc d\nc d\ne")], "k long, text string")
    v = {r.k: r.fingerprint for r in H.fingerprints(df, ["k"]).collect()}
    assert v[1] == v[2] and len(set(v.values())) == 3
    # inserting a paragraph adds its vector
    lanes = lambda f: [int(f[i:i + 8], 16) for i in range(0, 64, 8)]
    only = {r.k: r.fingerprint for r in H.fingerprints(spark.createDataFrame([(9, "e")], "k long, text string"), ["k"]).collect()}
    assert [(a + b) % 2**32 for a, b in zip(lanes(v[3]), lanes(only[9]))] == lanes(v[1])
