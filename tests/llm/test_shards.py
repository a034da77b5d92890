"""Virtual slots: query against plain sums, maps edited with few moves."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tabkit.llm import shards as S
from tabkit.llm.queries import all_queries


def test_query(spark, sf_dir):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = all_queries()["op2_virtual_slots"].build(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    load, places, moved = Counter(), defaultdict(list), []
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        assert r.law == "bytes" and r.grown_shard is None and r.map_version == 1
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
        if r.shard != r.rebalanced_shard:
            moved.append(r)
    assert set(load) == set(range(16))
    assert max(load.values()) - min(load.values()) <= max(r.size for r in rows)
    for slots in places.values():
        assert sorted(slots) == list(range(len(slots)))
    assert sum(r.size for r in moved) < 2 * sum(load.values()) / 17
    assert {tuple(r) for r in rows} == {tuple(r) for r in all_queries()["op2_virtual_slots"].build(spark, sf_dir).collect()}


def test_maps_balance_and_move_little():
    rng = random.Random(3)
    sizes = {s: (int(rng.paretovariate(2) * 1000), 5) for s in range(4000)}
    sizes[9] = (0, 0)
    total = sum(b for b, _ in sizes.values())

    def loads(m, n):
        out = [0] * n
        for s, shard in m.items():
            out[shard] += sizes[s][0]
        return out

    first = S.new_map(sizes, 16)
    assert max(loads(first, 16)) - min(loads(first, 16)) < 0.01 * total / 16
    grown = S.rebalance(first, sizes, 17)
    assert max(loads(grown, 17)) < 1.05 * total / 17
    moved = [s for s in sizes if first[s] != grown[s]]
    assert sum(sizes[s][0] for s in moved) < 1.3 * total / 17
    shrunk = S.rebalance(first, sizes, 15)
    assert all(shrunk[s] == first[s] for s in sizes if first[s] != 15 and shrunk[s] == first[s])
    assert max(loads(shrunk, 15)) < 1.05 * total / 15
    assert S.rebalance(first, sizes, 16) == first or sum(sizes[s][0] for s in sizes if S.rebalance(first, sizes, 16)[s] != first[s]) < 0.01 * total


def test_stored_versions(spark, tmp_path):
    path = f"file://{tmp_path}/map"
    sizes = {s: (s, 1) for s in range(8)}
    assert S.stored_versions(spark, path) == []
    assert S.store_map(spark, path, S.new_map(sizes, 2), sizes) == 1
    (tmp_path / "map" / "_temporary" / "0").mkdir(parents=True)  # a write that died
    assert S.stored_versions(spark, path) == [1]
    assert S.store_map(spark, path, S.new_map(sizes, 3), sizes) == 2
    assert {r.shard for r in S.load_map(spark, path).collect()} == {0, 1, 2}
    assert {r.shard for r in S.load_map(spark, path, 1).collect()} == {0, 1}


def test_nulls_repeats_empty_and_clashes(spark):
    df = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (None, "", None), (2, "é", "z")] * 3,
                               "doc_id long, text string, Slot_ string")
    sized = df.select("*", S.text_size().alias("size"), S.text_crc32().alias("crc"))
    slotted = S.with_slots(sized, "size", "crc", slots=16)
    sizes = S.slot_sizes(slotted, "size", 16)
    m = spark.createDataFrame([(1, s, sh, *sizes[s]) for s, sh in S.new_map(sizes, 3).items()], S.MAP_SCHEMA)
    rows = S.assign(slotted, m, ["doc_id"]).collect()
    assert len(rows) == 12 and {r["size"] for r in rows if r.text is None} == {1}
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert S.assign(S.with_slots(sized.limit(0), "size", "crc", slots=16), m, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        S.assign(slotted.withColumnRenamed("Slot_", "SHARD"), m, ["doc_id"])
