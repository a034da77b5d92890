"""WARC writer and reader: round trips, revisits, identical reruns."""

import base64
import gzip
import hashlib
import os
from collections import Counter

import pytest

from tabkit.llm import warc as W
from tabkit.llm.queries import all_queries


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_query(spark, sf_dir):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    rows = all_queries()["op9_sharded_warc"].build(spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        data = pages[r.page_id]
        origin = first[data]
        assert (r.payload_bytes, r.payload_digest) == (len(data), b32(data))
        assert (r.record_type, r.refers_to) == (("response", None) if origin == r.page_id else ("revisit", origin))


ROWS = [(5, "http://a/\r\nX: y z é", "same", "k"), (2, "http://b", "same", "k"), (9, None, None, "k"), (7, "u", "", None),
        (2, "http://b", "same", "k"), (2, "http://b", "other ñ\r\n\r\nx", "k"), (None, "n", "same", "k"),
        (None, "n", "alone", "k"), (None, "n", "alone", "k"), (11, "u", "z" * 300_000, "k"), (10**12, "far", "p", "k")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, payload string")


def files(folder):
    return {f: open(f"{folder}/{f}", "rb").read() for f in os.listdir(folder) if f.startswith("shard-")}


def test_odd_rows_and_small_files(spark, odd, tmp_path):
    path = f"file://{tmp_path}/w"
    manifest = W.write(odd, path, shard_bytes=2000, file_bytes=500).collect()
    assert sum(r.records for r in manifest) == len(ROWS) and len(manifest) > 3
    on_disk = files(tmp_path / "w")
    for r in manifest:
        assert hashlib.sha256(on_disk[r.file]).hexdigest() == r.sha256 and len(on_disk[r.file]) == r.bytes
    assert not [f for f in os.listdir(tmp_path / "w") if f.endswith(".tmp")]
    rows = W.read(spark, path).collect()
    got = Counter((r.page, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows)
    kind = {(5, "same"): [("revisit", 2)], (2, "same"): [("response", None), ("revisit", 2)], (9, ""): [("revisit", 7)],
            (7, ""): [("response", None)], (2, "other ñ\r\n\r\nx"): [("response", None)], (None, "same"): [("revisit", 2)],
            (None, "alone"): [("response", None), ("revisit", None)], (11, "z" * 300_000): [("response", None)],
            (10**12, "p"): [("response", None)]}
    assert got == Counter((i, t, ref, len(h.encode()), b32(h.encode())) for (i, h), v in kind.items() for t, ref in v)
    back = {(r.page, bytes(r.payload).decode()) for r in rows if r.record_type == "response"}
    assert back == {(i, h or "") for i, _, h, _ in ROWS} - {(5, "same"), (9, ""), (None, "same")}
    urls = {r.url for r in rows}
    assert "http://a/%0D%0AX:%20y%20z%20é" in urls and "urn:page:9" in urls


def test_reruns_are_equal_byte_for_byte(spark, odd, tmp_path):
    for name, df in (("a", odd), ("b", odd.repartition(5))):
        W.write(df, f"{tmp_path}/{name}", shard_bytes=2000, file_bytes=500)
    assert files(tmp_path / "a") == files(tmp_path / "b")
    before = files(tmp_path / "a")
    W.write(odd, f"{tmp_path}/a", shard_bytes=2000, file_bytes=500)  # over its own files, as after a lost task
    assert files(tmp_path / "a") == before


def test_small_payloads_are_not_revisited(spark, odd, tmp_path):
    W.write(odd, f"{tmp_path}/m", min_revisit=100)
    assert {r.record_type for r in W.read(spark, f"{tmp_path}/m").collect()} == {"response"}


def test_empty_table(spark, odd, tmp_path):
    assert W.write(odd.limit(0), f"{tmp_path}/e").count() == 0
    assert W.read(spark, f"{tmp_path}/e").count() == 0


def test_damage_is_noticed(spark, odd, tmp_path):
    W.write(odd, f"{tmp_path}/d")
    name = next(f for f in files(tmp_path / "d") if f.endswith(".gz"))
    raw = gzip.decompress(open(tmp_path / "d" / name, "rb").read())
    at = raw.index(b"alone")
    from io import BytesIO
    members = gzip.compress(raw[:at] + b"xlone" + raw[at + 5:])
    with pytest.raises(Exception):
        list(W.parse_records(BytesIO(members)))
    open(tmp_path / "d" / name, "wb").write(members)
    with pytest.raises(Exception):
        W.read(spark, f"{tmp_path}/d").collect()
