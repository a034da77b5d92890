"""Log-bilinear language model: counted, trained and applied by Spark tasks.

Texts are lower-cased in ASCII and cut into words at ASCII white space; one end
closes each text.  The *units* of the model are the ends, the ``OWN`` most
frequent words, and ``CLASSES`` classes of all other words (by a checksum of
their first two bytes).  The vector predicted for a place is the sum of its
``CONTEXT`` previous units' vectors, each weighted by a diagonal matrix of its
distance; a unit's score is the product with its own vector, plus a bias.

1.  Words of the training texts are counted: each task sends its distinct words
    (in bounded blocks), one aggregate sums them.  The table of counts has a
    row per distinct word; it is never collected.
2.  Training is noise-contrastive.  All training texts are dealt into a few
    parts; in every round each task starts at the shared model and goes through
    all its texts of one part in blocks: block
    products with the true units and with units drawn from the unigram
    distribution, logistic loss, adaptive steps in numpy.  It sends one row per
    vector; the next model is their mean, weighted by tokens.  Biases start at
    the unigram distribution, so that training sets out from the base model.
3.  Scoring computes all units' scores of a block of places as one matrix
    product and normalises them: a token's probability is its unit's, times, for
    a word of a class, its smoothed share of the class.  Words that no training
    text holds share the same probability that add-one smoothing gives them,
    taken off all others, so that probabilities of all words sum to one.

Counts meet the tokens in two ways.  Words with more than ``total / HOT_WORDS``
occurrences -- so at most ``HOT_WORDS`` of them -- are broadcast; all other
tokens, rare by the same rule, are joined to the table by word, one row per word
and text.  No word has more training occurrences there than that share, and
which texts are held out is a hash of the id, so a word that is rare in training
is rare in them too (where one id is repeated without end, Spark's adaptive join
divides its rows).

What reaches the driver: totals, hot words and the model (a fixed number of
vectors).  Results depend on how Spark splits the training texts, as a sum of
tasks does; a repeated task repeats its result.

Results for odd input: a null text is an empty one, that is, one end; a null id
hashes like an empty one; repeated rows are texts of their own; long texts and
words are read whole (words above ``LONG`` bytes are told apart by their
SHA-256); without training texts every token has probability one, as the base
has; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize
from tabkit.llm.common import col, holds, slices, task_memory

OWN, CLASSES, CONTEXT, WIDTH = 191, 64, 4, 16
NOISE, BLOCK, PARTS, RATE = 32, 1024, 2, 0.1
HOT_WORDS = 1_000_000
FLUSH_WORDS = 500_000
LONG = 40
#: Texts read at once, and places scored at once.
PIECE, PLACES = 1024 * 1024, 2048
END = 0


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; words above :data:`LONG` bytes by their digest."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass").lower()
    words = raw.split()
    if len(raw) > LONG:
        data = np.frombuffer(raw, np.uint8)
        blanks = np.flatnonzero((data == 32) | (data - np.uint8(9) < 5))
        if np.diff(blanks, prepend=-1, append=len(raw)).max() > LONG + 1:
            words = [w if len(w) <= LONG else b"sha256:" + sha256(w).hexdigest().encode() for w in words]
    return words


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n`` over the column ``text``; the ends are the word of no
    bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def block() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                             names=["word", "n"])
            counts.clear()
            return out

        with task_memory("lm"):
            for batch in chain.from_iterable(slices(b, PIECE) for b in batches):
                for text in batch.column(0).to_pylist():
                    counts.update(words_of(text))
                counts[b""] += batch.num_rows
                if len(counts) > FLUSH_WORDS:
                    yield block()
            yield block()

    return texts.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Totals, the hot words with their counts, and the units."""
    tokens: int
    distinct: int
    words: list[bytes]      # hot words, own words first
    counts: np.ndarray      # of the hot words
    own: int
    shares: np.ndarray      # training tokens of each unit
    smoothed: np.ndarray    # per unit the sum of count + 1 over its words

    def unit_of_hot(self) -> np.ndarray:
        """Unit of each hot word."""
        return np.array([1 + i if i < self.own else 1 + self.own + class_of(w) for i, w in enumerate(self.words)], np.int16)


def class_of(word: bytes) -> int:
    return zlib.crc32(word[:2]) % CLASSES


def vocabulary(counts: DataFrame, own: int = OWN, hot_words: int = HOT_WORDS) -> Vocabulary:
    """Of a table of :func:`word_counts` (``counts`` is read three times)."""
    total = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct"),
                       F.sum(F.when(F.length("word") == 0, F.col("n"))).alias("ends")).first()
    tokens, distinct, ends = total.tokens or 0, total.distinct if total.tokens else 0, total.ends or 0
    words = counts.where(F.length("word") > 0)
    hot = [(bytes(r.word), r.n) for r in words.where(F.col("n") >= tokens // hot_words + 1).collect()]
    hot.sort(key=lambda r: (-r[1], r[0]))
    own = min(own, len(hot))
    shares, smoothed = np.zeros(1 + own + CLASSES), np.ones(1 + own + CLASSES)
    shares[END] = ends
    shares[1:1 + own] = [n for _, n in hot[:own]]
    place = (F.crc32(F.substring("word", 1, 2)) % CLASSES).cast("int")
    for r in words.groupBy(place.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("m")).collect():
        shares[1 + own + r.c], smoothed[1 + own + r.c] = r.n, r.n + r.m
    for w, n in hot[:own]:  # own words are in no class
        shares[1 + own + class_of(w)] -= n
        smoothed[1 + own + class_of(w)] -= n + 1
    return Vocabulary(tokens, distinct, [w for w, _ in hot], np.array([n for _, n in hot], np.int64), own, shares, smoothed)


@dataclass
class Model:
    """Vectors of the units as context and as outcome, diagonal weights by
    distance, and biases."""
    context: np.ndarray
    outcome: np.ndarray
    distance: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.outcome, self.distance, self.bias[:, None]]

    def by_distance(self) -> list[np.ndarray]:
        """Per distance, the weighted vector of every unit."""
        return [self.context * d for d in self.distance]

    def log_probabilities(self, before: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Natural logarithms, normalised over all units, for places whose
        previous units are the rows of ``before`` (the nearest first)."""
        out, tables = np.empty(len(units)), self.by_distance()
        last = np.vstack([self.outcome.T, self.bias])  # the bias as one more product
        for at in range(0, len(units), PLACES):
            guess = predicted(tables, before[at:at + PLACES])
            scores = np.column_stack([guess, np.ones(len(guess), guess.dtype)]) @ last
            own = scores[np.arange(len(scores)), units[at:at + PLACES]]
            with np.errstate(over="ignore"):
                total = np.exp(scores).sum(axis=1)
            odd = np.flatnonzero(~((total > 1e-30) & (total < 1e30)))
            total = np.log(total, where=total > 0, out=np.zeros(len(total), total.dtype))
            if len(odd):  # scores beyond what exp takes
                top = scores[odd].max(axis=1, keepdims=True)
                total[odd] = top[:, 0] + np.log(np.exp(scores[odd] - top).sum(axis=1))
            out[at:at + PLACES] = own - total
        return out


def predicted(tables: list[np.ndarray], before: np.ndarray) -> np.ndarray:
    """Sum of the previous units' weighted vectors."""
    out = tables[0][before[:, 0]]
    for k in range(1, before.shape[1]):
        out += tables[k][before[:, k]]
    return out


def new_model(v: Vocabulary, width: int = WIDTH, context: int = CONTEXT, seed: int = 42) -> Model:
    """Random small vectors; the unigram distribution as biases (units that
    hold no word are out of reach)."""
    rng, n = np.random.default_rng(seed), len(v.shares)
    with np.errstate(divide="ignore"):
        bias = np.maximum(np.log(v.shares / max(v.tokens, 1)), -1e4)
    small = lambda: rng.normal(0, 0.1, (n, width)).astype(np.float32)
    distance = np.repeat(1.0 / np.arange(1, context + 1), width).reshape(context, width).astype(np.float32)
    return Model(small(), small(), distance, bias.astype(np.float32))


def places(units: np.ndarray, ends: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token, the unit, its previous units (ends before the first), and
    the text: of texts whose words' units lie one after another up to
    ``ends``, with one end added to each."""
    sizes = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    # all in one row, each text between ``context`` ends before and one behind
    row = np.full(len(text) + context * len(sizes), END, units.dtype)
    at = np.arange(len(text)) + context * (text + 1)
    last = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(text), bool)
    inside[last] = False
    row[at[inside]] = units
    return row[at], np.stack([row[at - k - 1] for k in range(context)], 1), text


class Trainer:
    """Noise-contrastive training of a copy of a model."""

    def __init__(self, model: Model, shares: np.ndarray, rate: float, seed: int):
        self.model = Model(*(a.copy() for a in (model.context, model.outcome, model.distance, model.bias)))
        self.rate, self.rng = rate, np.random.default_rng(seed)
        noise = shares / shares.sum()
        self.steps = np.cumsum(noise)
        with np.errstate(divide="ignore"):
            self.odds = (np.log(noise) + math.log(NOISE)).astype(np.float32)
        self.squares = [np.full_like(a, 1e-2) for a in self.model.arrays()]

    def _step(self, which: int, rows, gradient: np.ndarray) -> None:
        """An adaptive step on some rows of an array."""
        if which == 3:
            gradient = gradient[:, None]
        squares = self.squares[which][rows] + gradient * gradient
        self.squares[which][rows] = squares
        self.model.arrays()[which][rows] -= self.rate * gradient / np.sqrt(squares)

    @staticmethod
    def _by_unit(units: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of rows by unit."""
        order = np.argsort(units, kind="stable")
        at = units[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        return at[first], np.add.reduceat(rows[order], first)

    def block(self, units: np.ndarray, before: np.ndarray) -> None:
        m = self.model
        drawn = np.minimum(np.searchsorted(self.steps, self.rng.random(NOISE), "right"), len(self.steps) - 1)
        tables = m.by_distance()
        guess, true = predicted(tables, before), m.outcome[units]
        # chances that a unit is data and not noise, less what it is
        data = np.einsum("ij,ij->i", guess, true) + m.bias[units] - self.odds[units]
        data = (-1 / (1 + np.exp(np.clip(data, -30, 30)))).astype(np.float32)
        other = m.outcome[drawn]
        fake = guess @ other.T + (m.bias[drawn] - self.odds[drawn])
        fake = (1 / (1 + np.exp(-np.clip(fake, -30, 30)))).astype(np.float32)
        back = data[:, None] * true + fake @ other
        moved = np.concatenate([data[:, None] * guess, fake.T @ guess])
        which = np.concatenate([units, drawn.astype(units.dtype)])
        rows, sums = self._by_unit(which, np.column_stack([moved, np.concatenate([data, fake.sum(axis=0)])]))
        near = [back * m.distance[k] for k in range(before.shape[1])]
        turned = np.stack([(back * m.context[before[:, k]]).sum(axis=0) for k in range(before.shape[1])])
        held, shifts = self._by_unit(before.T.ravel(), np.concatenate(near))
        self._step(1, rows, sums[:, :-1])
        self._step(3, rows, sums[:, -1])
        self._step(0, held, shifts)
        self._step(2, slice(None), turned)


_rng = np.random.Generator(np.random.PCG64(20260117))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(LONG, _BASE)]))


@dataclass
class Flat:
    """The words of several texts in one row of lower-case bytes."""
    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    ends: np.ndarray    # of each text among the words

    @staticmethod
    def of(texts: list[str | None]) -> Flat:
        raw = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        blank = (data == 32) | (data - np.uint8(9) < 5)
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1  # words and gaps in turn
        if not blank[0]:
            edge = np.concatenate([[0], edge])
        start, stop = edge[::2], edge[1::2]
        tails = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        return Flat(data, start, stop - start, np.searchsorted(start, tails))

    def word(self, i: int) -> bytes:
        """As :func:`words_of` has it."""
        w = self.data[self.start[i]:self.start[i] + self.size[i]].tobytes()
        return w if len(w) <= LONG else b"sha256:" + sha256(w).hexdigest().encode()

    def heads(self) -> np.ndarray:
        """The first two bytes of each word as a number (one byte: below 256)."""
        first = self.data[self.start].astype(np.int32)
        return np.where(self.size > 1, (first + 1) * 256 + self.data[self.start + (self.size > 1)], first)

    def hashes(self) -> np.ndarray:
        """64 bits of each word (of its first bytes, where it is long)."""
        size = np.minimum(self.size, LONG + 1)
        ends = np.cumsum(size)
        at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
        value = _BYTE[self.data[np.repeat(self.start, size) + at]] * _POWERS[at]
        return np.add.reduceat(value, ends - size) + self.size.astype(np.uint64) * _BASE if len(ends) else np.zeros(0, np.uint64)


class Words:
    """Hot words and units, in one Python worker."""

    def __init__(self, v: Vocabulary):
        self.v, self.first = v, 1 + v.own
        # a table by 64-bit hash, with open addressing (two words of a corpus of
        # 10^9 distinct ones share a hash of a hot word with a chance of 10^-4)
        short = [i for i, w in enumerate(v.words) if len(w) <= LONG]
        hashes = np.zeros(len(v.words), np.uint64)
        if short:
            hashes[short] = Flat.of([v.words[i].decode("utf-8", "surrogatepass") for i in short]).hashes()
        self.size = 1 << max(4, (4 * len(v.words)).bit_length())
        self.shift = np.uint64(64 - self.size.bit_length() + 1)
        self.table = np.full(self.size, -1, np.int32)
        self.hash = hashes
        for i in short:
            slot = int(self._slot(hashes[i:i + 1])[0])
            while self.table[slot] >= 0:
                slot = (slot + 1) % self.size
            self.table[slot] = i
        self.unit = np.append(v.unit_of_hot(), np.int16(0))
        self.class_unit = np.array([self.first + class_of(bytes([h]) if h < 256 else bytes([h // 256 - 1, h % 256]))
                                    for h in range(257 * 256)], np.int16)
        self.long = {w: i for i, w in enumerate(v.words) if len(w) > LONG}

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)

    def read(self, flat: Flat) -> tuple[np.ndarray, np.ndarray]:
        """Place among the hot words (-1: none) and unit of each word."""
        hashes, hot = flat.hashes(), np.full(len(flat.start), -1, np.int32)
        if self.v.words:
            slot, left = self._slot(hashes), np.arange(len(hashes))
            while len(left):
                found = self.table[slot]
                same = (found >= 0) & (self.hash[found] == hashes[left])
                hot[left[same]] = found[same]
                on = (found >= 0) & ~same
                left, slot = left[on], (slot[on] + 1) % self.size
        units = np.where(hot >= 0, self.unit[hot], self.class_unit[flat.heads()])
        for i in np.flatnonzero(flat.size > LONG).tolist():  # known by their digest
            w = flat.word(i)
            hot[i] = self.long.get(w, -1)
            units[i] = self.unit[hot[i]] if hot[i] >= 0 else self.first + class_of(w)
        return hot, units


_WORDS: dict[str, Words] = {}
holds("lm", _WORDS.clear)


def _words(key: str, shared) -> Words:
    """One per Python worker and vocabulary."""
    if key not in _WORDS:
        _WORDS.clear()
        _WORDS[key] = Words(shared.value)
    return _WORDS[key]


def train(texts: DataFrame, v: Vocabulary, parts: int = PARTS, rate: float = RATE, width: int = WIDTH,
          context: int = CONTEXT, seed: int = 42, epochs: int = 1) -> Model:
    """A model of the column ``text``.  The rows are dealt into ``parts`` by a
    hash of the text; a round takes one part, an epoch takes all."""
    model = new_model(v, width, context, seed)
    if not v.tokens:
        return model
    shared, key = texts.sparkSession.sparkContext.broadcast(v), uuid.uuid4().hex
    sizes = [a.shape[0] for a in model.arrays()]
    lanes = [f"v{i}" for i in range(width)]
    for r in range(parts * epochs):
        start, speed = model, rate / (1 + r)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with task_memory("lm"):
                words, seen = _words(key, shared), 0
                trainer = Trainer(start, v.shares, speed, hash((seed, r, TaskContext.get().partitionId())) % (1 << 32))
                for batch in chain.from_iterable(slices(b, PIECE) for b in batches):
                    flat = Flat.of(batch.column(0).to_pylist())
                    units, before, _ = places(words.read(flat)[1], flat.ends, context)
                    for at in range(0, len(units), BLOCK):
                        trainer.block(units[at:at + BLOCK], before[at:at + BLOCK])
                    seen += len(units)
                if not seen:
                    return
                flat = np.concatenate([np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in trainer.model.arrays()])
                flat = flat.astype(float) * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat)), pa.int32()), pa.array(np.full(len(flat), float(seen))),
                     *(pa.array(np.ascontiguousarray(flat[:, i])) for i in range(width))], names=["row", "seen", *lanes])

        part = texts.where(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(parts)) == r % parts)
        sent = part.select("text").mapInArrow(run, "row int, seen double, " + ", ".join(f"{x} double" for x in lanes))
        found = sent.groupBy("row").agg(*(F.sum(x).alias(x) for x in ("seen", *lanes))).collect()  # one row per vector
        flat = np.zeros((sum(sizes), width), np.float32)
        for row in found:
            flat[row.row] = np.array(row[2:]) / row.seen
        at = np.cumsum([0, *sizes])
        a, b, c, d = (flat[at[i]:at[i + 1]] for i in range(4))
        model = Model(a, b, c, d[:, 0].copy())
    return model


def scored(df: DataFrame, counts: DataFrame, v: Vocabulary, model: Model, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` and the base-10
    logarithms ``base_score`` and ``score`` of every row."""
    context, size = model.distance.shape[0], v.tokens + v.distinct + 1
    shared, key = df.sparkSession.sparkContext.broadcast(v), uuid.uuid4().hex
    spare = math.log10(size)              # an unseen word's, negated
    rest = math.log10(1 - 1 / size) if v.tokens else 0.0
    whole = np.log10(v.smoothed.clip(1))  # of each class, with those of own words and ends unused
    to_ten = 1 / math.log(10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("lm"):
            words = _words(key, shared)
            log_count = np.log10(np.append(v.counts, 0) + 1.0)
            for batch in chain.from_iterable(slices(b, PIECE) for b in batches):
                flat = Flat.of(batch.column(2).to_pylist())
                hot, units = words.read(flat)
                units, before, doc = places(units, flat.ends, context)
                n = batch.num_rows
                is_end = np.concatenate([doc[1:] != doc[:-1], [True]])[:len(doc)]
                place = np.full(len(units), -2)  # an end
                place[~is_end] = hot
                log_p = model.log_probabilities(before, units) * to_ten if v.tokens else np.zeros(len(units))
                known = (place != -1) & (v.tokens > 0)
                in_class = units > v.own
                log_n = np.where(is_end, math.log10(v.shares[END] + 1), log_count[np.maximum(place, -1)])
                score = np.where(known, log_p + rest + np.where(in_class, log_n - whole[units], 0.0), 0.0)
                base = np.where(known, log_n - spare, 0.0)
                rare = np.flatnonzero(place == -1)
                # what a rare word's score is, but for its count; equal words of a text are one
                rare_score = log_p[rare] + rest - whole[units[rare]]
                found: dict[tuple[int, bytes], int] = {}
                which = [found.setdefault((d, flat.word(i)), len(found))  # places less the ends before
                         for d, i in zip(doc[rare].tolist(), (rare - doc[rare]).tolist())]
                texts: list[list[str]] = [[] for _ in range(n)]
                for d, w in found:
                    texts[d].append(w.decode("utf-8", "surrogatepass"))
                cuts = np.concatenate([[0], np.cumsum(list(map(len, texts)))]).astype(np.int32)
                times = np.bincount(which, minlength=len(found)).astype(np.int32)
                rare_score = np.bincount(which, rare_score, len(found))
                add = lambda x: pa.array(np.bincount(doc, x, n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.bincount(doc, minlength=n), pa.int64()),
                     pa.array(np.bincount(doc, known, n).astype(np.int64)), add(base), add(score),
                     pa.array([" ".join(t) if t else None for t in texts], pa.string()),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(times)),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(rare_score))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "times", "rare_score"])

    kind = df.schema[doc_id].dataType.simpleString()
    part = materialize(df.select(col(doc_id).alias("doc_id"), is_held_out(col(doc_id)).alias("held_out"), col(text).alias("text"))
                       .mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
                                        "score double, rare string, times array<int>, rare_score array<double>"))
    part = part.withColumn("row", F.monotonically_increasing_id())
    # no word holds a blank
    tokens = F.explode(F.arrays_zip(F.split("rare", " ").alias("word"), F.col("times").alias("k"), F.col("rare_score").alias("s")))
    once = part.where("rare is not null").select("row", tokens.alias("r")).select(
        "row", F.col("r.word").cast("binary").alias("word"), F.col("r.k").alias("k"), F.col("r.s").alias("s"))
    log_n = F.log10(F.col("n") + 1)
    met = once.join(counts.select("word", "n"), "word", "left").select(
        "row", F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0).alias("known"),
        (F.col("k") * (F.coalesce(log_n, F.lit(0.0)) - spare)).alias("base"),
        F.when(F.col("n").isNotNull(), F.col("s") + F.col("k") * log_n).otherwise(F.col("k") * -spare).alias("score"))
    added = met.groupBy("row").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_base"),
                                   F.sum("score").alias("more_score"))
    plus = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).alias(x)
    return part.drop("rare", "times", "rare_score").join(added, "row", "left").select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "more_known"), F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        plus("base_score", "more_base"), plus("score", "more_score"))


def score(df: DataFrame, text: str = "text", doc_id: str = "doc_id", epochs: int = 1) -> DataFrame:
    """Every row scored by a model of those not held out."""
    texts = df.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    training = texts.where(~is_held_out(F.col("doc_id"))).select("text")
    counts = materialize(word_counts(training))
    v = vocabulary(counts)
    return scored(df, counts, v, train(training, v, epochs=epochs), text, doc_id)
