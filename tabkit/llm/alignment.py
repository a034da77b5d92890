"""Alignment of two tokenizers over the same bytes.

Each text is encoded by a byte-level BPE file (A) and by a piece model with
byte fallback (B).  Byte offsets at which a token of both ends cut the tokens
into *groups*; two occurrences are *linked* when their byte ranges overlap, and
the count of an id pair is the number of documents that hold it linked.

All groups and links of a batch of texts come from a few vector operations.
Offsets at which any token ends cut the bytes into segments; a segment lies in
one token of either side, and each link is exactly one segment, so links are
never searched for.

Neither side's tokens run across a blank between two other characters (the
pattern of A begins a match there; no piece of B holds a blank behind another
character, which is checked), so texts are cut at such blanks.  What lies between is
encoded and aligned once and remembered, up to ``MEMO_CHUNKS`` of them; texts
with any other spacing are one chunk.

Identity map.  For every id of A the id of B with the same bytes is precomputed
(-1 if none).  A group of one token on either side is such a pair and is
counted, like the same pair inside a larger group, in one vector as long as the
vocabulary, per task; a task sends as many rows at most.  Only pairs of
irregular groups are counted by key and enter the shuffle, summed inside each
task first (``FLUSH_PAIRS`` at most are held).

Counts then go back to the documents.  Identity counts and the highest count of
every id of A are vectors of the vocabulary's length.  Of the irregular pairs,
those with a count above ``total / HOT_PAIRS`` -- so at most ``HOT_PAIRS`` of
them, whatever the input's size -- are broadcast as two sorted arrays; the
others are rare by the same rule, and join by key, no key with more rows than
that share.  Nothing is dropped and no group of rows is unbounded.

Results for odd input: texts that are null or empty, or whose tokens do not
join to a space and the text (B may change white space or characters), have no
tokens: zeros and an empty string; strings of special tokens inside a text are
plain text; repeated rows and null ids are documents of their own; a long text
is aligned whole; an empty table gives an empty table; other columns are not
read, only the id is carried.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, fields
from hashlib import sha256
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabkit.functions.frames import materialize
from tabkit.llm.bpe import read_ranks
from tabkit.llm.common import col, holds, slices, task_memory

HOT_PAIRS = 500_000
FLUSH_PAIRS = 2_000_000
#: Text aligned at once, in bytes.
PIECE = 1024 * 1024
#: Chunks that a Python worker remembers, of so many characters at most.
MEMO_CHUNKS, MEMO_LENGTH = 300_000, 64
#: Chunks encoded at once.
TOGETHER = 200
_NEW, _ODD = -1, -2


def byte_of_character() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable
    Latin-1 stands for itself, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_level_tokens(raw: bytes) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary; empty for special ones."""
    spec = json.loads(raw)
    special = {t["id"] for t in spec["added_tokens"]}
    vocab, table = spec["model"]["vocab"], byte_of_character()
    out = [b""] * (max([*vocab.values(), *special]) + 1)
    for entry, number in vocab.items():
        if number not in special:
            out[number] = bytes(map(table.__getitem__, entry))
    return out


def piece_tokens(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Bytes of every id of a piece model; empty for control ids."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i):
            out.append(b"")
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


class Vocabulary:
    """Bytes of all ids as one row, with where each id's begin."""

    def __init__(self, tokens: list[bytes]):
        self.tokens, self.n = tokens, len(tokens)
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one after another."""
        size = self.length[ids]
        ends = np.cumsum(size)
        return self.blob[np.repeat(self.start[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def identity_map(a: list[bytes], b: list[bytes], last: frozenset[int] = frozenset()) -> np.ndarray:
    """Per id of ``a`` the id of ``b`` with the same bytes; -1 where there is
    none.  Of several, those outside ``last`` first, then the smallest."""
    number: dict[bytes, int] = {}
    for i in sorted(range(len(b)), key=lambda i: (i in last, i)):
        if b[i]:
            number.setdefault(b[i], i)
    return np.fromiter((number.get(t, -1) for t in a), np.int64, len(a))


@dataclass
class Aligned:
    """Some texts or chunks: token, group and link numbers of each, its groups
    as text, whether its tokens join to it, and, one after another, its ids of
    A linked with their identical id of B and its other linked pairs, each with
    how often."""
    counts: np.ndarray      # n_a, n_b, n_groups, n_links: one row each
    groups: list[str]
    fits: np.ndarray
    same: np.ndarray
    same_times: np.ndarray
    n_same: np.ndarray
    pairs: np.ndarray
    pair_times: np.ndarray
    n_pairs: np.ndarray

    @staticmethod
    def none() -> Aligned:
        zero = np.zeros(0, np.int64)
        return Aligned(np.zeros((4, 0), np.int64), [], np.zeros(0, bool), zero, zero, zero, zero, zero, zero)

    def __add__(self, other: Aligned) -> Aligned:
        both = lambda name: np.concatenate([getattr(self, name), getattr(other, name)], axis=-1)
        return Aligned(both("counts"), self.groups + other.groups, *(both(f.name) for f in fields(Aligned)[2:]))


def _runs(sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the items of the groups ``which`` lie, in groups of ``sizes`` one
    after another, and how many each has."""
    starts, n = np.cumsum(sizes) - sizes, sizes[which]
    ends = np.cumsum(n)
    return np.repeat(starts[which] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0), n


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, in order, with the sums of their ``times``."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


class Aligner:
    """Two tokenizers, read from the bytes of their files."""

    def __init__(self, a_file: bytes, b_file: bytes):
        self.a_model = Tokenizer.from_str(a_file.decode())
        self.a_model.encode_special_tokens = True
        self.b_model = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a, self.b = Vocabulary(byte_level_tokens(a_file)), Vocabulary(piece_tokens(self.b_model))
        self.same = identity_map(self.a.tokens, self.b.tokens,
                                 frozenset(i for i in range(self.b.n) if self.b_model.is_byte(i)))
        text = [np.array([f"{i}{mark}" for i in range(n)], object) for n, mark in
                ((self.a.n, ","), (self.a.n, "|"), (self.b.n, ","), (self.b.n, ";"))]
        self.a_inside, self.a_last, self.b_inside, self.b_last = text
        self.cuts = not any(re.search(b"[^ ] ", t) for t in self.b.tokens)
        self.forget()

    def forget(self) -> None:
        """Drop what was remembered of texts."""
        self.number: dict[str, int] = {}
        self.known = Aligned.none()

    def _ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
        """Ids of both sides, and whether they join to a space and the text."""
        one = self.a_model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        two = self.b_model.encode(texts, num_threads=1)
        a, b = [np.array(x.ids, np.int64) for x in one], [np.array(x, np.int64) for x in two]
        raw = [np.frombuffer(b" " + t.encode("utf-8", "surrogatepass"), np.uint8) for t in texts]
        return a, b, [all(np.array_equal(v.joined(i), r) for v, i in ((self.a, x), (self.b, y))) for x, y, r in zip(a, b, raw)]

    def encode(self, texts: list[str], together: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, those of all texts in one row; the end of each
        text among their bytes; and which texts fit (the others have no ids).
        Texts that are chunks may be encoded ``together``, with blanks between
        them; where that does not fit, one by one."""
        parts = [texts[i:i + together] for i in range(0, len(texts), together)]
        a, b, fits, ends, at = [], [], [], [], 0
        for part, x, y, fit in zip(parts, *self._ids([" ".join(p) for p in parts])):
            size = np.fromiter((len(t.encode("utf-8", "surrogatepass")) + 1 for t in part), np.int64, len(part))
            stop = np.cumsum(size)
            if len(part) > 1 and not (fit and all(np.isin(stop, np.cumsum(v.length[i])).all() for v, i in ((self.a, x), (self.b, y)))):
                x, y, stop, good = self.encode(part)
            else:
                good = np.full(len(part), fit)
                if not fit:
                    x, y, stop = x[:0], y[:0], stop * 0
            a.append(x), b.append(y), fits.append(good), ends.append(stop + at)
            at += int(stop[-1])
        return tuple(map(np.concatenate, (a, b, ends, fits)))

    def align_texts(self, texts: list[str | None]) -> Aligned:
        """Whole texts, cut into chunks where that changes nothing."""
        if len(self.number) > MEMO_CHUNKS:
            self.forget()
        cut = [[] if not t else t.split(" ") if self.cuts else [t] for t in texts]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        chunks, number = list(chain.from_iterable(cut)), self.number
        which = np.fromiter(map(number.get, chunks, repeat(_NEW)), np.int64, len(chunks))
        missing = np.flatnonzero(which == _NEW).tolist()
        fresh = dict.fromkeys(chunks[i] for i in missing)
        if self.cuts:
            for c in fresh:  # a blank beside another one, or beside white space
                if not c or c[0].isspace() or c[-1].isspace():
                    number[c] = _ODD
        fresh = [c for c in fresh if c not in number]
        kept = [c for c in fresh if len(c) <= MEMO_LENGTH]
        if kept:
            number.update(zip(kept, range(len(self.known.groups), len(self.known.groups) + len(kept))))
            self.known = self.known + self.align(*self.encode(kept, TOGETHER))
        # those that are not remembered, and texts that are not cut, behind the others
        once = {c: i for i, c in enumerate((c for c in fresh if len(c) > MEMO_LENGTH), len(self.known.groups))}
        which[missing] = [number.get(c, once.get(c)) for c in map(chunks.__getitem__, missing)]
        odd = np.unique(np.repeat(np.arange(len(cut)), n)[which == _ODD]).tolist()
        first = len(self.known.groups) + len(once)
        behind = [*once, *(texts[i] for i in odd)]
        known = self.known + self.align(*self.encode(behind)) if behind else self.known
        if odd:
            whole = np.zeros(len(cut), bool)
            whole[odd] = True
            ends = np.cumsum(n)
            which = np.concatenate([[first + odd.index(i)] if w else which[e - k:e]
                                    for i, (w, e, k) in enumerate(zip(whole.tolist(), ends.tolist(), n.tolist()))])
            n = np.where(whole, 1, n)
        doc = np.repeat(np.arange(len(cut)), n)
        fits = np.bincount(doc, ~known.fits[which], len(cut)) == 0
        fits &= n > 0
        which, doc = which[fits[doc]], doc[fits[doc]]
        counts = np.stack([np.bincount(doc, c[which], len(cut)).astype(np.int64) for c in known.counts])
        ends = np.cumsum(np.bincount(doc, minlength=len(cut))).tolist()
        words = [known.groups[i] for i in which.tolist()]
        groups = [";".join(words[s:e]) for s, e in zip([0, *ends[:-1]], ends)]
        at, size = _runs(known.n_same, which)
        key, times = _summed(np.repeat(doc, size) * self.a.n + known.same[at], known.same_times[at])
        at, size = _runs(known.n_pairs, which)
        width = self.a.n * self.b.n
        pair, pair_times = _summed(np.repeat(doc, size) * width + known.pairs[at], known.pair_times[at])
        count = lambda d: np.bincount(d, minlength=len(cut)).astype(np.int64)
        return Aligned(counts, groups, fits, key % self.a.n, times, count(key // self.a.n),
                       pair % width, pair_times, count(pair // width))

    def align(self, a_ids: np.ndarray, b_ids: np.ndarray, text_ends: np.ndarray, fits: np.ndarray) -> Aligned:
        """Groups and links of texts, from :meth:`encode`."""
        n_docs = len(text_ends)
        a_ends, b_ends = np.cumsum(self.a.length[a_ids]), np.cumsum(self.b.length[b_ids])
        doc, b_doc = np.searchsorted(text_ends, a_ends), np.searchsorted(text_ends, b_ends)
        n_a, n_b = np.bincount(doc, minlength=n_docs), np.bincount(b_doc, minlength=n_docs)
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        ends = np.union1d(a_ends, b_ends)
        # a segment ends at each of ``ends``; it lies in the first token that does not end before
        in_a, in_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        link_doc, x, y = doc[in_a], a_ids[in_a], b_ids[in_b]
        alike = self.same[x] == y
        key, times = np.unique(link_doc[alike] * self.a.n + x[alike], return_counts=True)
        pair, pair_times = np.unique(link_doc[~alike] * (self.a.n * self.b.n) + x[~alike] * self.b.n + y[~alike],
                                     return_counts=True)
        same_doc, pair_doc = key // self.a.n, pair // (self.a.n * self.b.n)
        # the groups as text: after each group's ids of A come its ids of B
        a_last, b_last = np.isin(a_ends, common, assume_unique=True), np.isin(b_ends, common, assume_unique=True)
        words = np.empty(len(a_ids) + len(b_ids), object)
        b_before = np.searchsorted(b_group, a_group)  # ids of B in the groups before
        words[np.arange(len(a_ids)) + b_before] = np.where(a_last, self.a_last[a_ids], self.a_inside[a_ids])
        a_upto = np.searchsorted(a_group, b_group, "right")
        words[np.arange(len(b_ids)) + a_upto] = np.where(b_last, self.b_last[b_ids], self.b_inside[b_ids])
        cut = np.concatenate([[0], np.cumsum(n_a + n_b)])
        groups = ["".join(words[s:e].tolist())[:-1] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]
        count = lambda d: np.bincount(d, minlength=n_docs).astype(np.int64)
        return Aligned(np.stack([n_a, n_b, count(doc[a_last]), count(link_doc)]), groups, fits,
                       key % self.a.n, times, count(same_doc), pair % (self.a.n * self.b.n), pair_times, count(pair_doc))


_ALIGNERS: dict[str, Aligner] = {}
holds("alignment", _ALIGNERS.clear)


def _aligner(key: str, a_file, b_file) -> Aligner:
    """One aligner per Python worker and call."""
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
        _ALIGNERS[key] = Aligner(a_file.value, b_file.value)
    return _ALIGNERS[key]


def _binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * data.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
        None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column, and the row of each."""
    rows = column.to_pylist()
    sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), np.repeat(np.arange(len(rows)), sizes)


def aligned(df: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups_sha256``; ``same`` and ``same_times``, the ids of A linked with
    their identical id of B and how often (32-bit numbers); ``pairs`` and
    ``pair_times``, the other linked pairs (64-bit ``a * size of B + b``)."""
    context = df.sparkSession.sparkContext
    a_file, b_file = context.broadcast(read_ranks(a_path)), context.broadcast(read_ranks(b_path))
    name = uuid.uuid4().hex
    numbers, arrays = ("n_a", "n_b", "n_groups", "n_links"), ("same", "same_times", "pairs", "pair_times")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("alignment"):
            aligner = _aligner(name, a_file, b_file)
            for batch in chain.from_iterable(slices(b, PIECE) for b in batches):
                found = aligner.align_texts(batch.column(1).to_pylist())
                hashes = [sha256(g.encode()).hexdigest() if f else "" for g, f in zip(found.groups, found.fits.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, found.counts), pa.array(hashes, pa.string()),
                     _binaries(found.same.astype(np.int32), found.n_same), _binaries(found.same_times.astype(np.int32), found.n_same),
                     _binaries(found.pairs, found.n_pairs), _binaries(found.pair_times.astype(np.int32), found.n_pairs)],
                    names=["doc_id", *numbers, "groups_sha256", *arrays])
            aligner.forget()

    kind = df.schema[doc_id].dataType.simpleString()
    return df.select(col(doc_id).alias("doc_id"), col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in numbers) + ", groups_sha256 string, "
        + ", ".join(f"{n} binary" for n in arrays))


def pair_counts(rows: DataFrame, same: np.ndarray, b_size: int) -> DataFrame:
    """``pair``, ``n``, ``alike``: in how many rows of :func:`aligned` each
    linked pair occurs, and whether it is one of the identity map ``same``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(pair: np.ndarray, n: np.ndarray, alike: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64()),
                                               pa.array(np.full(len(pair), alike))], names=["pair", "n", "alike"])

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

        vector, kept, waiting = np.zeros(len(same), np.int64), [], 0
        with task_memory("alignment"):
            for batch in chain.from_iterable(map(slices, batches)):
                ids, _ = _numbers(batch.column(0), np.int32)
                vector += np.bincount(ids, minlength=len(same))
                pairs, _ = _numbers(batch.column(1), np.int64)
                kept.append(np.unique(pairs, return_counts=True))
                waiting += len(kept[-1][0])
                if waiting > FLUSH_PAIRS:
                    kept = [merged(kept)]
                    waiting = len(kept[0][0])
                    if waiting > FLUSH_PAIRS // 2:
                        yield block(*kept.pop(), False)
                        waiting = 0
            if kept:
                yield block(*merged(kept), False)
            seen = np.flatnonzero(vector)
            yield block(seen * b_size + same[seen], vector[seen], True)

    parts = rows.select("same", "pairs").mapInArrow(run, "pair bigint, n bigint, alike boolean")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"), F.first("alike").alias("alike"))


def _column(rows: list, name: str) -> np.ndarray:
    return np.fromiter((r[name] for r in rows), np.int64, len(rows))


def scored(rows: DataFrame, same: np.ndarray, b_size: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Rows of :func:`aligned` with ``n_best`` (links whose pair's count is the
    highest of its id of A) and ``count_sum`` (over links) in place of the
    arrays."""
    counts = materialize(pair_counts(rows, same, b_size))
    size = len(same)
    best, alike = np.zeros(size, np.int64), np.zeros(size, np.int64)
    first = F.expr(f"pair div {b_size}L").alias("a")
    tops = counts.groupBy(first).agg(F.max("n").alias("top"), F.sum(F.when(F.col("alike"), F.col("n"))).alias("alike"),
                                     F.sum(F.when(~F.col("alike"), F.col("n"))).alias("other")).collect()
    total = 0  # one row per id of A at most
    for r in tops:
        best[r.a], alike[r.a] = r.top, r.alike or 0
        total += r.other or 0
    cut = total // hot_pairs + 1  # at most ``hot_pairs`` reach it
    hot = counts.where((~F.col("alike")) & (F.col("n") >= cut)).select("pair", "n").orderBy("pair").collect()
    context = rows.sparkSession.sparkContext
    known = context.broadcast((best, alike, _column(hot, "pair"), _column(hot, "n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("alignment"):
            best, alike, pair, pair_n = known.value
            for batch in chain.from_iterable(map(slices, batches)):
                c = dict(zip(batch.schema.names, batch.columns))
                ids, at = _numbers(c["same"], np.int32)
                times = _numbers(c["same_times"], np.int32)[0].astype(np.int64)
                n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                np.add.at(total, at, times * alike[ids])
                np.add.at(n_best, at, times * (alike[ids] == best[ids]))
                keys, at = _numbers(c["pairs"], np.int64)
                times = _numbers(c["pair_times"], np.int32)[0].astype(np.int64)
                if len(pair):
                    place = np.minimum(np.searchsorted(pair, keys), len(pair) - 1)
                    met = pair[place] == keys
                    n = pair_n[place[met]]
                    np.add.at(total, at[met], times[met] * n)
                    np.add.at(n_best, at[met], times[met] * (n == best[keys[met] // b_size]))
                    keys, at, times = keys[~met], at[~met], times[~met]
                left = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=batch.num_rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(c[n] for n in plain), pa.array(n_best), pa.array(total),
                     pa.ListArray.from_arrays(pa.array(left), pa.array(keys)),
                     pa.ListArray.from_arrays(pa.array(left), pa.array(times))],
                    names=[*plain, "n_best", "count_sum", "rare", "rare_times"])

    plain = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    part = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, f"row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "n_best bigint, count_sum bigint, rare array<bigint>, rare_times array<bigint>")
    one = part.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("r")).select(
        "row", F.col("r.rare").alias("pair"), F.col("r.rare_times").alias("times"))
    highest = rows.sparkSession.createDataFrame([(r.a, r.top) for r in tops], "a bigint, top bigint")
    few = counts.where((~F.col("alike")) & (F.col("n") < cut)).select("pair", "n", first).join(
        F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("is_best"))
    rare = one.join(few, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("rare_best"),
        F.sum(F.col("n") * F.col("times")).alias("rare_sum"))
    plus = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).alias(x)
    return part.drop("rare", "rare_times").join(rare, "row", "left").select(
        *plain[1:], plus("n_best", "rare_best"), plus("count_sum", "rare_sum"))


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id",
          hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256`` of every row."""
    known = Aligner(read_ranks(a_path), read_ranks(b_path))
    rows = materialize(aligned(df, a_path, b_path, text, doc_id))
    return scored(rows, known.same, known.b.n, hot_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
