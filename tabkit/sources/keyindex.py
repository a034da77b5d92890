"""Keyed index of what a table holds (S6, J2): deliveries that read few files.

Beside a Parquet table lies a table ``<target>-keys`` with a row per data file:
its number of rows, the least and greatest key, and a Bloom filter of the keys
(``BITS_PER_KEY`` bits each, ``PROBES`` probes).  A delivery is tested against
these rows first; the anti join then reads only the files that may hold one of
its keys.  A Bloom filter never misses a key, so the rows appended are those of
:func:`tabkit.sources.ingest.append_new`.

The index follows the files: whatever file of the table is not in it yet --
written by another job, or by a run that failed between the append and the
index -- is indexed before the next test.  Files of the table are immutable
(appends add files), as Spark writes them.

The keys of a delivery are broadcast, as 64-bit hashes, if there are
``MAX_KEYS`` at most (counted); a larger delivery is tested by its key range
alone, which rules out fewer files and no more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.sources.ingest import ingest_incremental, split_keyed
from tabkit.sources.io import path_exists

BITS_PER_KEY, PROBES = 12, 6
MAX_KEYS = 2_000_000


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The probed bits of each key: one row per key (``bits`` a power of two)."""
    h = hashes.astype(np.uint64)
    step = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(17)) | np.uint64(1)
    return (h[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def bloom(hashes: np.ndarray) -> bytes:
    """A filter of keys given by their 64-bit hashes."""
    bits = 1 << max(6, math.ceil(math.log2(max(1, len(hashes)) * BITS_PER_KEY)))
    flat = np.zeros(bits, bool)
    flat[_places(hashes, bits).ravel()] = True
    return np.packbits(flat, bitorder="little").tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> bool:
    """Whether a filter may hold one of the keys."""
    data = np.frombuffer(filter_, np.uint8)
    for at in range(0, len(hashes), 100_000):
        p = _places(hashes[at:at + 100_000], 8 * len(data))
        if ((data[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1).any():
            return True
    return False


def index_path(target_path: str) -> str:
    return f"{target_path.rstrip('/')}-keys"


def refresh_index(spark: SparkSession, target_path: str, id_col: str) -> int:
    """Index the files of a table that are not in its index; returns how many
    they were."""
    path = index_path(target_path)
    files = set(spark.read.parquet(target_path).inputFiles())
    if path_exists(spark, path):
        files -= {r["file"] for r in spark.read.parquet(path).select("file").collect()}  # one name per file
    if not files:
        return 0
    table = spark.read.parquet(*sorted(files))
    kind = table.schema[id_col].dataType.simpleString()

    def sidecar(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        known = rows.dropna(subset=["k"])
        low, high = (known["k"].min(), known["k"].max()) if len(known) else (None, None)
        return pd.DataFrame({"file": [key[0]], "n": [len(rows)], "low": [low], "high": [high],
                             "keys": [bloom(known["h"].to_numpy(np.int64))]})

    # a group is one file's key column
    rows = table.select(F.col("_metadata.file_path").alias("f"), F.col(f"`{id_col}`").alias("k"))
    made = (rows.withColumn("h", F.xxhash64("k")).groupBy("f")
            .applyInPandas(sidecar, f"file string, n bigint, low {kind}, high {kind}, keys binary"))
    # the listing's names, which may be written otherwise than the metadata's
    made.withColumn("file", F.regexp_replace("file", r"^file:/+", "file:///")).write.mode("append").parquet(path)
    return len(files)


def files_that_may_hold(spark: SparkSession, keys: DataFrame, id_col: str, target_path: str,
                        max_keys: int = MAX_KEYS) -> list[str]:
    """The data files of an indexed table that may hold one of ``keys``."""
    own = keys.select(F.col(f"`{id_col}`").alias("k")).where("k is not null").distinct()
    span = own.agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).first()
    if not span["n"]:
        return []
    index = spark.read.parquet(index_path(target_path))
    near = index.where((F.col("high") >= F.lit(span["low"])) & (F.col("low") <= F.lit(span["high"])))
    if span["n"] <= max_keys:
        hashes = np.array([r["h"] for r in own.select(F.xxhash64("k").alias("h")).collect()], np.int64)
        held = spark.sparkContext.broadcast(hashes)

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = [f for f, keys_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                         if may_hold(keys_, held.value)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

        near = near.select("file", "keys").mapInArrow(test, "file string")
    return sorted(r["file"] for r in near.select("file").distinct().collect())


def append_indexed(spark: SparkSession, new: DataFrame, target_path: str, id_col: str, resume_from=None,
                   order_col: str | None = None) -> tuple[int, list[str]]:
    """S6 sink with an index: append the unseen rows of ``new`` to the Parquet
    table at ``target_path``; rows without key are left out (see
    :func:`tabkit.sources.ingest.split_keyed`).  Returns the number appended and
    the files that were read for it."""
    files: list[str] = []
    existing = None
    if path_exists(spark, target_path):
        refresh_index(spark, target_path, id_col)
        files = files_that_may_hold(spark, split_keyed(new, id_col)[0], id_col, target_path)
        existing = spark.read.parquet(*files) if files else None
    # computed before the append changes the table
    rows = ingest_incremental(new, existing, id_col, resume_from, order_col).checkpoint(eager=True)
    n = rows.count()
    if n:
        rows.write.mode("append").parquet(target_path)
        refresh_index(spark, target_path, id_col)
    return n, files
