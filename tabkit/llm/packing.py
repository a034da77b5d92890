"""Best-fit-decreasing packing of token ids into rows of fixed length.

Documents longer than a row are split into row-length pieces and a rest, with
nothing lost or repeated.  Pieces are taken in falling order of length and put
into the row with the least space that still suffices; a segment tree over the
space values 0..capacity finds that row in logarithmic time.  A packed row holds

* ``ids``: ``capacity`` little-endian unsigned integers (padded with ``pad``),
* ``positions``: the same shape, counting from 0 again in every segment,
* ``cu_seqlens``: cumulative segment lengths, from 0,
* ``doc_ids`` and ``starts``: per segment its document and the place of its first
  token there (so that documents can be put together again).

Packing works on windows of about ``window`` tokens inside each input
partition: nothing is shuffled, memory is bounded, a lost task packs the same
rows again, and a row is left part-empty only at a window's end.  A hot source
or group of copies is spread as its files are.

Results for odd input: a null or empty list of ids gives no segment; a null id
of a document stays null in ``doc_ids``; repeated rows are packed repeatedly;
an empty table gives no rows; an id that does not fit the integer type is an
error; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.bpe import read_ranks
from tabkit.llm.common import check_free, col, holds, slices


class SpaceTree:
    """Rows by their free space, with a segment tree that counts the rows per
    space value."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        node = space + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, wanted: int) -> tuple[int, int]:
        """Space and number of a row with the least space of ``wanted`` at
        least, which is removed; (-1, -1) if there is none."""
        node = wanted + self.leaves
        if not self.count[node]:
            # up to the first subtree on the right that holds a row, then down
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return -1, -1
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        space = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return space, self.rows[space].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[tuple[int, int]], int]:
    """Row and offset of each piece, and the number of rows.  Pieces of equal
    length keep their order."""
    placed: list[tuple[int, int]] = [(-1, -1)] * len(lengths)
    tree, rows = SpaceTree(capacity), 0
    for k in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        length = lengths[k]
        space, row = tree.take(length) if length < capacity else (-1, -1)
        if row < 0:
            space, row, rows = capacity, rows, rows + 1
        placed[k] = (row, capacity - space)
        if space > length:
            tree.add(space - length, row)
    return placed, rows


def pack_window(doc_ids: list, lists: list[np.ndarray], capacity: int, pad: int, dtype: str) -> pa.RecordBatch:
    """The packed rows of one window."""
    pieces = [(d, at, min(capacity, len(ids) - at)) for d, ids in enumerate(lists) for at in range(0, len(ids), capacity)]
    placed, rows = best_fit_decreasing([n for _, _, n in pieces], capacity)
    matrix = np.full((rows, capacity), pad, dtype)
    positions = np.zeros((rows, capacity), dtype)
    count = np.arange(capacity, dtype=dtype)
    segments: list[list[tuple]] = [[] for _ in range(rows)]
    for (d, at, n), (row, offset) in zip(pieces, placed):
        matrix[row, offset:offset + n] = lists[d][at:at + n]
        positions[row, offset:offset + n] = count[:n]
        segments[row].append((offset, n, doc_ids[d], at))
    for row in segments:
        row.sort(key=lambda s: s[0])
    ends = [[0] + [offset + n for offset, n, _, _ in row] for row in segments]
    return pa.RecordBatch.from_arrays(
        [pa.array([r.tobytes() for r in matrix], pa.binary()), pa.array([r.tobytes() for r in positions], pa.binary()),
         pa.array(ends, pa.list_(pa.int32())), pa.array([[s[2] for s in row] for row in segments], pa.list_(pa.int64())),
         pa.array([[s[3] for s in row] for row in segments], pa.list_(pa.int32()))],
        names=["ids", "positions", "cu_seqlens", "doc_ids", "starts"])


PACKED = "ids binary, positions binary, cu_seqlens array<int>, doc_ids array<bigint>, starts array<int>"


def pack(df: DataFrame, ids: str = "ids", doc_id: str = "doc_id", capacity: int = 2048, pad: int = 0,
         window: int = 4_000_000, dtype: str = "<u2") -> DataFrame:
    """Packed rows (see the module's text) of the ids in ``df``."""
    if not 0 < capacity <= np.iinfo(dtype).max + 1:
        raise ValueError("capacity must be above 0 and positions must fit the integer type")
    most = int(np.iinfo(dtype).max)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lists, held = [], [], 0
        for batch in chain.from_iterable(map(slices, batches)):
            rows = batch.column(1)
            flat = rows.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and not (0 <= flat.min() and flat.max() <= most):
                raise ValueError(f"an id is null or does not fit {dtype}")
            flat = flat.astype(dtype)
            at = 0
            for name, n in zip(batch.column(0).to_pylist(), rows.value_lengths().fill_null(0).to_pylist()):
                names.append(name)
                lists.append(flat[at:at + n])
                at, held = at + n, held + n
                if held >= window:
                    yield pack_window(names, lists, capacity, pad, dtype)
                    names, lists, held = [], [], 0
        if held:
            yield pack_window(names, lists, capacity, pad, dtype)

    return df.select(col(doc_id).cast("bigint"), col(ids).cast("array<bigint>")).mapInArrow(run, PACKED)


def unpack(packed: DataFrame, dtype: str = "<u2") -> DataFrame:
    """Segments of packed rows: ``doc_id``, ``start`` and ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, ends = np.frombuffer(row["ids"], dtype), row["cu_seqlens"]
                out += [(d, s, ids[a:b].astype(np.int32)) for d, s, a, b in zip(row["doc_ids"], row["starts"], ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return packed.select("ids", "cu_seqlens", "doc_ids", "starts").mapInArrow(run, "doc_id bigint, start int, ids array<int>")


def documents_of(packed: DataFrame, dtype: str = "<u2") -> DataFrame:
    """``doc_id`` and ``ids`` of each document put together again (documents
    must have distinct ids)."""
    parts = unpack(packed, dtype).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "ids"))).alias("parts"))
    return parts.select("doc_id", F.flatten("parts.ids").alias("ids"))


_ENCODERS: dict = {}
holds("packing", _ENCODERS.clear)


def library_ids(df: DataFrame, rank_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with token ids from the tiktoken library in place of the text: the
    input of a packing run that has no ids yet."""
    check_free(df, out)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    at = df.columns.index(text)
    kept = [i for i in range(len(df.columns)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        key = (hash(ranks.value), pattern)
        if key not in _ENCODERS:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, ranks.value.splitlines()))}
            _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for batch in chain.from_iterable(map(slices, batches)):
            rows = [np.array(_ENCODERS[key].encode_ordinary(t or ""), np.int32) for t in batch.column(at).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), ids],
                                             names=[*(batch.schema.names[i] for i in kept), out])

    return df.mapInArrow(run, T.StructType([*(df.schema[i] for i in kept), T.StructField(out, T.ArrayType(T.IntegerType()))]))
