"""MinHash near duplicates through an LSH forest, links confirmed on full sets.

A document's set holds the distinct shingles of ``width`` words (words cut at
ASCII white space, A-Z lower-cased); a text with fewer words is one shingle, a
text without words has an empty set and is linked with nothing.  Two documents
are linked when their Jaccard similarity reaches the threshold (a fraction, so
the test is in whole numbers), and ``component_id`` is the smallest id that a
document reaches over links.

1.  One pass over the texts makes each set (as 64-bit hashes), its 128-bit name
    and 128 MinHash values.  Documents with equal sets share a name and are one
    *class* from here on: a group of exact copies of any size is one row.
2.  The forest.  ``TREES`` sorted orders, each over ``DEPTH`` values of the
    signature.  Classes with a common prefix of the starting depth are
    neighbours.  The starting depth is the deepest at which a pair at the
    threshold is missed by all trees with a chance below ``MISS``.
3.  In a region, pairs whose signatures agree enough (``SLACK`` standard
    deviations under the threshold) join a *candidate group*; each member sends
    one row.  Groups that meet in different trees are united with alternating
    large-star and small-star steps over those skinny rows.  A region of more
    than ``REGION`` classes is dealt into bounded parts, which unites what is
    alike.  Only if it then still holds more than one group, it goes on.  With
    ``REGION`` members at most outside its largest group, these meet all others
    in blocks, which takes about two rows per member.  Otherwise fresh MinHash
    values give its members longer prefixes in as many more trees as keep the
    chance to miss a pair below ``MISS`` (:func:`trees_for`), so regions shrink
    and rows grow with the number of members; what the longest prefix leaves
    meets in blocks.  So each pair of neighbours is compared or already in one
    group, whatever the size of the region.
4.  Each candidate group is solved exactly on full sets: a member is compared
    with all others in one vector operation, and only while it may still
    unite two parts.  Groups beyond ``BLOCK_ROWS`` members (or
    ``BLOCK_SHINGLES``) are cut into blocks that share some members; what then
    lies outside the group's largest component is compared with every block,
    so that no link inside a group is lost.

Only candidates' texts are shuffled, once; no pair table is made, nothing is
collected, and every grouping has a bounded size.

Results for odd input: null texts have empty sets; a null id never becomes a
component id unless the component has no other (then the component id is
null); rows that share id and text are one document, of which
``near_duplicates`` marks all rows alike and ``keep_one`` keeps one; an empty table gives an empty table; other columns are not read, and
names that clash are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize
from tabkit.llm.common import col, new_name, slices, task_memory

TREES, DEPTH = 16, 8
MISS = 2e-5
SLACK = 4.2
REGION = 1000
#: Prefix lengths of the further trees for members of large regions.
DEEPER = (8, 12, 16)
BLOCK_ROWS = 3000
BLOCK_SHINGLES = 4_000_000
SHARED_ROWS = 32
#: A candidate table of at most so many rows is broadcast; else it is joined by key.
BROADCAST_ROWS = 300_000
#: Text turned into sets at once, in bytes.
PIECE = 512 * 1024

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    space = _SPACE[data]
    letters = np.flatnonzero(~space)
    if not len(letters):
        return [np.empty(0, np.uint64)] * len(texts)
    # words: places in ``letters`` where the byte before is white space
    first = np.flatnonzero(np.concatenate([[True], np.diff(letters) > 1]))
    length = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters)) - np.repeat(first, length)
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(length.max()) - 1, _BASE)]))
    word = _mix(np.add.reduceat(_BYTE[data[letters]] * powers[place], first) + length.astype(np.uint64))
    doc = np.searchsorted(begins, letters[first], "right") - 1
    words = np.bincount(doc, minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(words)])
    n = max(0, len(word) - width + 1)
    whole = np.zeros(n, np.uint64)
    for k in range(width):
        whole += word[k:k + n] * _STEP[k % len(_STEP)] + np.uint64(k)
    whole = _mix(whole)
    out = []
    for i, count in enumerate(words.tolist()):
        at = int(starts[i])
        if count >= width:
            out.append(np.unique(whole[at:at + count - width + 1]))
        elif count:
            few = (word[at:at + count] * _STEP[:count]).sum(keepdims=True, dtype=np.uint64)
            out.append(_mix(few + np.uint64(0x5851F42D4C957F2D * count % 2**64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minhash(shingles: np.ndarray, mul: np.ndarray = _MUL, add: np.ndarray = _ADD) -> np.ndarray:
    """One value of 32 bits per hash function (``TREES * DEPTH`` of them)."""
    least = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 65536 // len(mul))
    for at in range(0, len(shingles), step):
        np.minimum(least, (shingles[at:at + step, None] * mul + add).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def start_depth(threshold: float) -> int:
    """The deepest prefix at which a pair at the threshold is found by some
    tree with a chance of ``1 - MISS`` at least."""
    found = [d for d in range(1, DEPTH + 1) if (1 - threshold ** d) ** TREES <= MISS]
    return max(found, default=1)


def trees_for(depth: int, threshold: float) -> int:
    """Trees with which a pair at the threshold is missed with a chance of
    ``MISS`` at most."""
    return math.ceil(math.log(MISS) / math.log1p(-threshold ** depth))


def set_name(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(docs: DataFrame, width: int, depth: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``node`` (name of the set),
    ``bits`` (8 bits of each MinHash value) and ``regions`` (one hash of the
    first ``depth`` values per tree)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("near_dups"):
            for batch in chain.from_iterable(slices(b, PIECE) for b in batches):
                sets = shingle_sets(batch.column(2).to_pylist(), width)
                values = np.stack([minhash(s) for s in sets]).reshape(len(sets), TREES, DEPTH)
                region = np.zeros((len(sets), TREES), np.uint64) + np.arange(TREES, dtype=np.uint64)
                for d in range(depth):
                    region = _mix(region * _BASE + values[:, :, d])
                low = np.ascontiguousarray(values.astype(np.uint8).reshape(len(sets), -1))
                regions = pa.FixedSizeListArray.from_arrays(pa.array(region.astype(np.int64).ravel()), TREES)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(list(map(set_name, sets)), pa.binary()),
                     pa.array([row.tobytes() for row in low], pa.binary()),
                     regions.cast(pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "n_shingles", "node", "bits", "regions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, n_shingles bigint, node binary, bits binary, regions array<bigint>")


def light(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast in joins if ``rows`` is ``BROADCAST_ROWS`` at
    most: a join by key of small tables costs two exchanges and meets in one
    task what belongs to a hot key."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def dealt(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``tree``, ``region``, ``node``: neighbourhoods of about ``REGION``
    classes at most, as ``region``, ``node`` (larger ones in random parts), and
    the larger ones whole, with their size ``n``."""
    counted = places.groupBy("tree", "region").agg(F.count("*").alias("n")).where("n > 1")
    rows = materialize(places.join(counted, ["tree", "region"]))
    large = rows.where(F.col("n") > REGION)
    part = F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("n") / REGION))
    found = rows.where(F.col("n") <= REGION).select("region", "node").unionByName(
        large.select(F.xxhash64("region", part).alias("region"), "node"))
    return found, large.select("region", "node", "n")


def forest_regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The neighbourhoods of all trees, as :func:`dealt` gives them."""
    return dealt(classes.select("node", F.posexplode("regions").alias("tree", "region")))


def unsettled(large: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The regions of ``large`` whose members are not all in one candidate
    group (``groups`` as in :func:`stars`): those with ``REGION`` members at most
    outside their largest group, and the others."""
    parted = large.join(groups.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    sizes = parted.groupBy("region", "root").agg(F.count("*").alias("m")).groupBy("region").agg(
        (F.sum("m") - F.max("m")).alias("outside")).where("outside > 0")
    several = materialize(large.join(light(sizes, large.count() // REGION), "region"))
    few = F.col("outside") <= REGION
    return several.where(few).drop("outside"), several.where(~few).drop("outside")


def united(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``groups`` with what ``edges`` add to them."""
    root = groups.select(F.col("u").alias("node"), F.col("v").alias("root"))
    ends = edges.join(root.toDF("u", "ru"), "u", "left").join(root.toDF("v", "rv"), "v", "left")
    new = materialize(ends.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")).where("u != v").distinct())
    return groups if new.isEmpty() else stars(groups.unionByName(new))


def deeper_regions(docs: DataFrame, classes: DataFrame, members: DataFrame, width: int, depth: int,
                   threshold: float) -> tuple[DataFrame, DataFrame]:
    """Neighbourhoods of ``members`` (``node``) under ``depth`` fresh MinHash
    values in each of :func:`trees_for` trees, as :func:`dealt` gives them."""
    trees = trees_for(depth, threshold)
    rng = np.random.Generator(np.random.PCG64(90_000 + depth))
    mul = rng.integers(1, 1 << 63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(1, 1 << 63, trees * depth, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("near_dups"):
            for batch in chain.from_iterable(slices(b, PIECE) for b in batches):
                sets = shingle_sets(batch.column(1).to_pylist(), width)
                values = np.stack([minhash(s, mul, add) for s in sets]).reshape(len(sets), trees, depth)
                region = np.zeros((len(sets), trees), np.uint64) + np.arange(trees, dtype=np.uint64)
                for d in range(depth):
                    region = _mix(region * _BASE + values[:, :, d])
                regions = pa.FixedSizeListArray.from_arrays(pa.array(region.astype(np.int64).ravel()), trees)
                yield pa.RecordBatch.from_arrays([batch.column(0), regions.cast(pa.list_(pa.int64()))], names=["node", "regions"])

    named = members.distinct().join(classes.select("node", "rep"), "node").select(
        "node", F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_hash").alias("text_hash"))
    # copies of one text make equal rows, reduced by the distinct below
    texts = texts_of(docs, materialize(named), "node")
    placed = texts.mapInArrow(run, "node binary, regions array<bigint>").select("node", F.posexplode("regions").alias("tree", "region"))
    return dealt(placed.distinct())


def texts_of(docs: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``name``, ``text`` of the documents that ``keys`` (``doc_id``,
    ``text_hash``, ``name``) names; a document delivered many times comes once
    from each input partition at most."""
    keyed = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_hash") == F.col("m.text_hash"))
    rows = docs.alias("d").join(keyed.alias("m"), same).select(F.col(f"m.{name}").alias(name), "d.text", "d.text_hash")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            new = [i for i, k in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
                   if not (k in seen or seen.add(k))]
            part = batch.take(pa.array(new, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=[name, "text"])

    kind = keys.schema[name].dataType.simpleString()
    return rows.mapInArrow(once, f"{name} {kind}, text string")


def meetings(large: DataFrame, groups: DataFrame) -> DataFrame:
    """``region``, ``node``: in each large region, the members outside its
    largest candidate group (``groups`` as in :func:`stars`) with all of its
    members, in blocks of about twice ``REGION`` rows."""
    parted = large.join(groups.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    counts = parted.groupBy("region", "root").agg(F.count("*").alias("m"))
    tops = counts.groupBy("region").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("all")) \
        .where(F.col("all") > F.col("top.m"))
    parts, chunks = F.ceil(F.col("n") / REGION), F.ceil((F.col("all") - F.col("top.m")) / REGION)
    rows = (parted.join(light(tops, large.count() // REGION), "region").withColumn("outside", F.col("root") != F.col("top.root"))
            .withColumn("parts", parts).withColumn("chunks", chunks)
            .withColumn("part", F.pmod(F.xxhash64("node", F.lit(4)), "parts"))
            .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(5)), "chunks")))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    asking = rows.where("outside").withColumn("part", every("parts"))
    asked = rows.withColumn("chunk", every("chunks"))
    block = F.xxhash64(F.lit("meet"), "region", "part", "chunk").alias("region")
    # an outside member is asking and asked in the blocks of its own part
    own = ~F.col("outside") | (F.col("chunk") != F.pmod(F.xxhash64("node", F.lit(5)), "chunks"))
    return asking.select(block, "node").unionByName(asked.where(own).select(block, "node"))


def _unite(n: int, others) -> np.ndarray:
    """Labels of the parts of ``range(n)`` that ``others(i)`` (a mask of the
    members linked with ``i``) connects.  The first member is asked, then
    whoever is outside the largest part, until all of these were: a link
    between two parts has one end that was asked."""
    labels, asked, i = np.arange(n), np.zeros(n, bool), 0
    while True:
        asked[i] = True
        for part in np.unique(labels[others(i)]):
            if part != labels[i]:
                labels[labels == part] = labels[i]
        due = np.flatnonzero((labels != np.bincount(labels).argmax()) & ~asked)
        if not len(due):
            return labels
        i = int(due[0])


def _spans(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return begin, np.append(begin[1:], len(keys))


def candidate_rows(regions: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """``u``, ``v`` (``u`` > ``v``): each member of a candidate group and the
    group's smallest member, per region (so a row may come many times)."""
    threshold = num / den
    width = TREES * DEPTH
    low = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / width)
    agree = int(math.floor(width * (low + (1 - low) / 256)))

    def solve(names: list[bytes], bits: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        def others(i: int) -> np.ndarray:
            near = (bits == bits[i]).sum(axis=1) >= agree
            return near & (den * np.minimum(sizes, sizes[i]) >= num * np.maximum(sizes, sizes[i]))

        if len(names) == 2:
            if others(0)[1]:
                yield names[1], names[0]
            return
        labels = _unite(len(names), others)
        for part in np.unique(labels):
            members = np.flatnonzero(labels == part).tolist()
            for m in members[1:]:
                yield names[m], names[members[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("near_dups"):
            held: pa.Table | None = None
            for batch in chain(batches, [None]):
                if batch is not None:
                    now = pa.Table.from_batches([batch])
                    held = now if held is None else pa.concat_tables([held, now])
                if held is None or not held.num_rows:
                    continue
                keys = held.column(0).to_numpy()
                begin, end = _spans(keys)
                if batch is not None:  # the last region may go on in the next batch
                    begin, end = begin[:-1], end[:-1]
                done = int(end[-1]) if len(end) else 0
                names = held.column(1).to_pylist()
                bits = np.frombuffer(b"".join(held.column(2).to_pylist()), np.uint8).reshape(-1, width)
                sizes = held.column(3).to_numpy()
                found = [pair for b, e in zip(begin.tolist(), end.tolist()) if e - b > 1
                         for pair in solve(names[b:e], bits[b:e], sizes[b:e])]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.binary()),
                                                  pa.array([p[1] for p in found], pa.binary())], names=["u", "v"])
                held = held.slice(done)

    rows = regions.join(classes.select("node", "bits", "n_shingles"), "node").select("region", "node", "bits", "n_shingles")
    n = max(1, int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n, "region").sortWithinPartitions("region", "node").mapInArrow(run, "u binary, v binary")


def stars(edges: DataFrame) -> DataFrame:
    """``u``, ``v``: every node of the graph but the roots, with the smallest
    node that it reaches.  Alternating large-star and small-star steps, each a
    partial aggregate and a join over the edges, until every node but the roots
    has one edge, to a root; edges are cut off by ``checkpoint`` after each
    round.  The joins of a small graph are broadcast, and so is the result."""
    e = materialize(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        rows, done = _settled(e)
        if done:
            return light(e, 2 * rows)
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(light(least, 2 * rows), "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        if 2 * rows > BROADCAST_ROWS:
            large = large.distinct()  # before it is shuffled
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(light(root, 2 * rows), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(root.select("u", F.col("m").alias("v"))).distinct())


def _settled(edges: DataFrame) -> tuple[int, bool]:
    """The number of ``edges``, and whether each ``u`` has one and is no ``v``."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    rows, open_ = nodes.agg(F.sum("up"), F.max((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0))).first()
    return rows or 0, not open_


def _exact(names: list[bytes], sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Labels of the parts that links on full sets connect."""
    sizes = np.array([len(s) for s in sets])
    _, ids, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # members whose shingles most others have come first: they unite the most
    order = np.argsort(-np.add.reduceat(df[ids], begin) / sizes, kind="stable")
    mark = np.zeros(len(df), np.int64)

    def others(k: int) -> np.ndarray:
        i = order[k]
        own = ids[begin[i]:begin[i] + sizes[i]]
        mark[own] = 1
        common = np.add.reduceat(mark[ids], begin)
        mark[own] = 0
        return (den * common >= num * (sizes + sizes[i] - common))[order]

    labels = np.empty(len(sets), np.int64)
    labels[order] = _unite(len(sets), others)
    return labels


def link_blocks(docs: DataFrame, members: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``u``, ``v``: members of a block with the smallest member that links on
    full sets reach inside the block.  ``members``: ``doc_id``, ``text_hash``,
    ``block``; rows of a block are solved together."""
    rows = texts_of(docs, members, "block")

    def solve(texts: list[str]) -> pa.RecordBatch:
        own = {}
        for at in range(0, len(texts), 64):
            for s in shingle_sets(texts[at:at + 64], width):
                if len(s):
                    own[set_name(s)] = s
        names = sorted(own)
        u, v = [], []
        if len(names) > 1:
            labels = _exact(names, [own[x] for x in names], num, den)
            for part in np.unique(labels):
                group = np.flatnonzero(labels == part).tolist()
                u += [names[g] for g in group[1:]]
                v += [names[group[0]]] * (len(group) - 1)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("near_dups"):
            block, texts = None, {}  # equal texts once
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if key != block:
                        if texts:
                            yield solve(list(texts))
                        block, texts = key, {}
                    texts[text] = None
            if texts:
                yield solve(list(texts))

    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (rows.repartition(n, "block").sortWithinPartitions("block").mapInArrow(run, "u binary, v binary"))


def _exact_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``u``, ``v`` as in :func:`stars`, over the links inside the candidate
    groups ``groups`` (also as in :func:`stars`)."""
    grouped = groups.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        groups.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    rows = 2 * groups.count()
    members = materialize(classes.select("node", "rep", "n_shingles").join(light(grouped, rows), "node"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("bigint")
    sizes = members.groupBy("root").agg(blocks.alias("blocks"))
    placed = materialize(members.join(light(sizes, rows), "root").withColumn("part", F.pmod(F.xxhash64("node"), "blocks")))
    key = [F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_hash").alias("text_hash")]
    first = placed.select(*key, F.xxhash64("root", "part").alias("block"))
    many = placed.where("blocks > 1")
    if many.isEmpty():
        return materialize(link_blocks(docs, first, width, num, den))
    # blocks of a large group share some members
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("node", F.lit(1)), "node"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    shared = (many.withColumn("rank", rank).where(F.col("rank") <= SHARED_ROWS).withColumn("other", every)
              .where("other != part").select(*key, F.xxhash64("root", "other").alias("block")))
    links = materialize(stars(link_blocks(docs, first.unionByName(shared), width, num, den)))
    # what lies outside the largest component of a large group meets every block
    parted = many.join(links.withColumnRenamed("u", "node"), "node", "left").withColumn("v", F.coalesce("v", "node"))
    counts = parted.groupBy("root", "v").agg(F.count("*").alias("n"))
    largest = counts.groupBy("root").agg(F.max(F.struct("n", "v")).alias("top"))
    outside = parted.join(largest, "root").where("v != top.v")
    chunks = outside.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("bigint").alias("chunks"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    block = F.xxhash64(F.lit(2), "root", "part", "chunk").alias("block")
    asking = (outside.join(chunks, "root").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(3)), "chunks"))
              .withColumn("part", every).select(*key, block))
    asked = many.join(chunks, "root").withColumn("chunk", chunk).select(*key, block)
    meeting = materialize(asking.unionByName(asked).distinct())
    if meeting.isEmpty():
        return links
    return stars(links.unionByName(link_blocks(docs, meeting, width, num, den)))


def _components(df: DataFrame, text: str, doc_id: str, width: int, threshold: tuple[int, int]) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` of every
    row, and ``first``: whether id and text are those of the component's first
    document (null where the set is empty)."""
    num, den = threshold
    depth = start_depth(num / den)
    docs = df.select(col(doc_id).alias("doc_id"), col(text).alias("text"), F.xxhash64(col(text)).alias("text_hash"))
    signed = materialize(signatures(docs, width, depth))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("rep")
    classes = materialize(signed.where("n_shingles > 0").groupBy("node").agg(
        rep, F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"), F.first("regions").alias("regions")))
    regions, large = forest_regions(classes)
    groups = stars(candidate_rows(regions, classes, num, den))
    for longer in (*DEEPER, None):
        if large.isEmpty():
            break
        few, large = unsettled(large, groups)
        meet = few if longer else few.unionByName(large)
        if not meet.isEmpty():
            groups = united(groups, candidate_rows(meetings(meet, groups), classes, num, den))
        if longer is None or large.isEmpty():
            break
        regions, large = deeper_regions(docs, classes, large.select("node"), width, longer, num / den)
        groups = united(groups, candidate_rows(regions, classes, num, den))
    links = _exact_links(docs, classes, groups, width, num, den)
    # first document of each component, per class
    rows = 2 * links.count()
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    reps = materialize(classes.select("node", "rep").join(light(ends, rows), "node"))
    least = reps.groupBy("root").agg(F.min("rep").alias("top"))
    linked = reps.join(light(least, rows), "root").select("node", "top")
    named = classes.select("node", "rep").join(light(linked, rows), "node", "left").select("node", F.coalesce("top", "rep").alias("top"))
    out = (signed.select("doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
           .join(named, "node", "left")
           .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id"))))
    first = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("text_hash") == F.col("top.text_hash"))
    return out.select("doc_id", "text_hash", "n_shingles", "component_id",
                      F.when(F.col("node").isNotNull(), first).alias("first"))


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5,
                    threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``kept``
    for every row of ``df``."""
    return _components(df, text, doc_id, width, threshold).select(
        "doc_id", "text_hash", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5,
             threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row of each component: of its first document (smallest id, nulls
    last, then hash of the text), and where that was delivered many times, the
    row with the smallest hash of all columns.  Rows with an empty set belong
    to no component and stay."""
    id_, hash_, row_ = (new_name(df, c) for c in ("_id", "_hash", "_row"))
    # each document in a component: gone, or there ``n`` times
    seen = materialize(_components(df, text, doc_id, width, threshold).where("first is not null")
                       .groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
                       .agg(F.min("first").alias("first"), F.count("*").alias("n")).where("not first or n > 1"))
    same = col(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(col(text)) == F.col(hash_))
    few = seen.count() <= BROADCAST_ROWS
    keys = seen.select(id_, hash_)
    once = df.join(F.broadcast(keys) if few else keys, same, "left_anti")
    again = seen.where("first").select(id_, hash_)
    if again.isEmpty():
        return once
    columns = [col(c) for c in df.columns]
    rows = df.join(F.broadcast(again) if few else again, same)
    one = rows.groupBy(id_, hash_).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(row_))
    return once.unionByName(one.select(f"{row_}.*"))
