"""Importance resampling towards a target distribution, on hashed n-grams.

Texts are lower-cased in ASCII and cut by an untrained ``Split`` of the
``tokenizers`` library, which returns each word with its offsets.  A feature is
a window of 1 to ``longest`` consecutive words, that is, the pair of its first
word's start and its last word's end; its bucket is the CRC-32 of the words
joined by one space, modulo ``buckets``.  The checksum of a window follows from
those of its words (appending ``n`` bytes to what is before is a linear map of
the 32 bits), so all windows of many texts are hashed by a few table lookups.

1.  One pass cuts the texts and stores each document's bucket numbers, two or
    four bytes a feature; texts are not read again.
2.  Each task adds its buckets up in one histogram; histograms of the documents
    and of the target texts are summed by bucket.  ``gain`` of a bucket is the
    log ratio of its smoothed shares, in thousandths.
3.  A document's weight is the sum of its features' gains.  With a Gumbel
    number from a hash of its id added, the highest scores are a weighted draw
    without replacement.  Rows of four numbers are sorted by ranges, and places
    follow from the sizes of the ranges before.

Only the two histograms (``buckets`` rows each) and one count per sorted range
reach the driver.  Histograms merge what a hot word or a group of copies adds
inside each task, and sorted ranges split between equal scores and equal ids.

Results for odd input: a null text has no words; a text without words has
weight 0; documents with fewer than ``min_words`` words are not drawn and have
a null rank; a null id hashes like an empty one and comes last among ties;
repeated rows are rows of their own with ranks of their own; a long text is
read whole; an empty table gives an empty table; with no target texts all
gains follow from smoothing alone; other columns pass through, and names that
clash with the columns added are an error.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from tabkit.functions.frames import materialize
from tabkit.llm.common import Memo, check_free, col, holds, slices, task_memory

# Fixed values.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
SEED = 42

#: Words of up to so many bytes have a table of their own for the appending step.
TABLED = 32
#: Texts cut at once, in bytes.
PIECE = 2 * 1024 * 1024
MEMO_WORDS = 200_000


def _append_tables() -> tuple[np.ndarray, np.ndarray]:
    """``[n][byte][value]``: what a CRC-32 becomes when ``n`` bytes follow, as
    the exclusive or over its four bytes; for ``n`` up to :data:`TABLED` and
    for the powers of two up to 2 ** 31."""
    first = np.array([zlib.crc32(bytes([v])) for v in range(256)], np.uint32)
    # appending a zero byte to the register, freed of the checksum's constants
    step = first ^ first[0]
    one = np.zeros((4, 256), np.uint32)
    values = np.arange(256, dtype=np.uint32)
    for k in range(4):
        register = values << np.uint32(8 * k)
        one[k] = (register >> np.uint32(8)) ^ step[register & np.uint32(255)]

    def then(table: np.ndarray, after: np.ndarray) -> np.ndarray:
        return np.stack([_through(after, table[k]) for k in range(4)])

    still = np.stack([values << np.uint32(8 * k) for k in range(4)])
    small = [still]
    for _ in range(TABLED):
        small.append(then(small[-1], one))
    powers = [one]
    for _ in range(31):
        powers.append(then(powers[-1], powers[-1]))
    return np.stack(small), np.stack(powers)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    return (table[0][crc & low] ^ table[1][(crc >> np.uint32(8)) & low]
            ^ table[2][(crc >> np.uint32(16)) & low] ^ table[3][crc >> np.uint32(24)])


_SMALL, _POWERS = _append_tables()
_FLAT = _SMALL.ravel()
_BLANK = np.uint32(zlib.crc32(b" "))


def appended(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part of the CRC-32 of ``a + b`` that comes from ``a``: ``crc`` are
    the checksums of the ``a``, ``n`` the lengths of the ``b``."""
    base = np.minimum(n, TABLED) * 1024
    out = np.zeros(len(crc), np.uint32)
    for k in range(4):
        out ^= _FLAT[base + (256 * k + ((crc >> np.uint32(8 * k)) & np.uint32(255)))]
    long = np.flatnonzero(n > TABLED)
    if len(long):
        value, left = crc[long], n[long].astype(np.int64)
        for j in range(32):
            odd = ((left >> j) & 1).astype(bool)
            value[odd] = _through(_POWERS[j], value[odd])
        out[long] = value
    return out


class WindowHasher:
    """Words and hashed windows of texts."""

    def __init__(self, buckets: int, longest: int, word: str = WORD):
        self.buckets, self.longest = buckets, longest
        self.split = pre_tokenizers.Split(Regex(word), "removed", invert=True)
        # checksum of a word, and its length above 32 bits
        self._word = Memo(lambda w: (lambda b: zlib.crc32(b) | len(b) << 32)(w.encode("utf-8", "surrogatepass")), MEMO_WORDS)

    def forget(self) -> None:
        self._word.forget()

    def words(self, text: str | None) -> list[tuple[str, tuple[int, int]]]:
        """Words with their offsets in the text."""
        if not text:
            return []
        lowered = text.lower() if text.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), text)
        return self.split.pre_tokenize_str(lowered)

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of words and of features per text, and the buckets of all
        features, text by text."""
        cut = [self.words(t) for t in texts]
        n_words = np.fromiter(map(len, cut), np.int64, len(cut))
        held = np.fromiter((self._word[w] for c in cut for w, _ in c), np.int64, int(n_words.sum()))
        crc, size = (held & 0xFFFFFFFF).astype(np.uint32), held >> 32
        doc = np.repeat(np.arange(len(cut)), n_words)
        found = np.zeros((len(crc), self.longest), np.uint32)
        valid = np.zeros((len(crc), self.longest), bool)
        before = crc  # checksums of the windows of k words
        for k in range(self.longest):
            if k:
                before = appended(appended(before[:-1], np.ones(len(before) - 1, np.int64)) ^ _BLANK, size[k:]) ^ crc[k:]
            found[:len(before), k] = before
            valid[:len(before), k] = doc[:len(doc) - k] == doc[k:]
            if len(before) < 2:
                break
        n_features = np.bincount(doc, valid.sum(axis=1), len(cut)).astype(np.int64)
        return n_words, n_features, found[valid] % np.uint32(self.buckets)


_HASHERS: dict[tuple, WindowHasher] = {}
holds("resampling", _HASHERS.clear)


def _hasher(buckets: int, longest: int) -> WindowHasher:
    if (buckets, longest) not in _HASHERS:
        _HASHERS.clear()
        _HASHERS[buckets, longest] = WindowHasher(buckets, longest)
    return _HASHERS[buckets, longest]


def _binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array of ``counts`` items of ``data`` each."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * data.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def hashed_windows(df: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST,
                   keep_text: bool = True) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``feature_buckets`` (numbers
    of two bytes, four above 65,536 buckets)."""
    kept = [i for i, c in enumerate(df.columns) if keep_text or c != text]
    at, names = df.columns.index(text), [df.columns[i] for i in kept]
    added = ["n_words", "n_features", "feature_buckets"]
    check_free(df.select(*(col(n) for n in names)), *added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("resampling"):
            hasher = _hasher(buckets, longest)
            for batch in chain.from_iterable(slices(b, PIECE) for b in batches):
                n_words, n_features, found = hasher.windows(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept), pa.array(n_words), pa.array(n_features),
                     _binaries(found.astype(_kind(buckets)), n_features)], names=[*names, *added])
            hasher.forget()

    schema = T.StructType([*(df.schema[i] for i in kept), T.StructField("n_words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("feature_buckets", T.BinaryType())])
    return df.mapInArrow(run, schema)


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and the end of each row among them."""
    rows = column.to_pylist()
    ends = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows))) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), ends


def histogram(hashed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: how many features of all rows fall in each bucket
    that occurs.  A task sends one row per bucket."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0), kind)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return (hashed.select("feature_buckets").mapInArrow(run, "bucket int, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket ``floor(1000 * ln(target share / source share))``, counts
    smoothed by one; from two tables as :func:`histogram` gives them."""
    def counts(table: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for bucket, n in table.select("bucket", "n").collect():
            out[bucket] = n
        return out

    s, t = counts(source), counts(target)
    all_s, all_t = float(s.sum()), float(t.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets))))
                     for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weighed(hashed: DataFrame, gain: np.ndarray) -> DataFrame:
    """``hashed`` with ``weight``, the sum of its features' gains, in place of
    the buckets."""
    kind = _kind(len(gain))
    names = [c for c in hashed.columns if c != "feature_buckets"]
    at = hashed.columns.index("feature_buckets")
    check_free(hashed, "weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            found, ends = _flat(batch.column(at), kind)
            sums = np.concatenate([[0], np.cumsum(gain[found])])
            weight = sums[ends] - sums[np.concatenate([[0], ends[:-1]])] if len(ends) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), pa.array(weight)],
                                             names=[*names, "weight"])

    schema = T.StructType([*(f for f in hashed.schema.fields if f.name != "feature_buckets"),
                           T.StructField("weight", T.LongType())])
    return hashed.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel number in thousandths, from the SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, doc_id: str = "doc_id", share: tuple[int, int] = (5, 100), min_words: int = MIN_WORDS,
           seed: int = SEED) -> DataFrame:
    """``rows`` (with ``n_words`` and ``weight``) with ``score`` and ``rank``:
    1, 2, 3... for the drawn ones, in the order of falling score, ties by id;
    null for the others.  ``share`` of the rows with ``min_words`` words or
    more are drawn, rounded down."""
    check_free(rows, "score", "rank", "_place", "_part", "_enough")
    spark = rows.sparkSession
    scored = (rows.withColumn("score", F.col("weight") + gumbel(col(doc_id), seed))
              .withColumn("_enough", F.col("n_words") >= min_words))
    # a number of its own per row splits equal scores and ids between ranges
    numbered = scored.withColumn("_place", F.monotonically_increasing_id())
    order = [F.desc("_enough"), F.desc("score"), F.asc_nulls_last(col(doc_id)), F.asc("_place")]
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = materialize(numbered.repartitionByRange(n, *order).sortWithinPartitions(*order))
    # an id made on the laid rows is the range's number above 33 bits, the place inside below
    placed = laid.withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.count_if("_enough").alias("m")).collect()
    drawn, start, before = sum(r.m for r in sizes) * share[0] // share[1], 0, []
    for r in sorted(sizes, key=lambda r: r["_part"]):
        before.append((r["_part"], start))
        start += r.n
    starts = spark.createDataFrame(before, "_part int, _before bigint")  # one row per range
    place = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(starts), "_part").select(
        *(col(c) for c in rows.columns), "score", F.when(F.col("_enough") & (place <= drawn), place).alias("rank"))


def resample(df: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
             buckets: int = BUCKETS, longest: int = LONGEST, share: tuple[int, int] = (5, 100),
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``df`` without its texts, with ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank``; the rows with a rank are the draw.  All other
    columns of ``df`` are sorted along, so pass only those that are needed."""
    hashed = materialize(hashed_windows(df, text, buckets, longest, keep_text=False))
    aimed = hashed_windows(target.select(col(target_text).alias("text")), "text", buckets, longest, keep_text=False)
    gain = gains(histogram(hashed, buckets), histogram(aimed, buckets), buckets)
    return ranked(weighed(hashed, gain), doc_id, share, min_words, seed)
