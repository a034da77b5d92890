"""Pieces shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.sources.tables import table

# Fixed value: a word is a run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of input that a Python task turns into one output batch.
BATCH_BYTES = 4 * 1024 * 1024


#: Entries of each memo of one Python worker.
MEMO_ENTRIES = 50_000


class Memo(dict):
    """``make(key)``, kept per key.  When full, what was not asked for since
    the last time it was full is dropped: memory is bounded by twice
    ``entries`` and frequent keys stay."""

    def __init__(self, make, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        """Drop all keys: Spark keeps idle Python workers, whose memory the
        next stage needs."""
        self.clear()
        self.older = {}


_HELD: dict[str, Callable[[], None]] = {}


def holds(owner: str, drop: Callable[[], None]) -> None:
    """Register how to drop what an operator keeps in a Python worker."""
    _HELD[owner] = drop


@contextmanager
def task_memory(owner: str) -> Iterator[None]:
    """Around the Python part of a task.  Spark keeps workers for later tasks
    of any operator: what other operators keep is dropped first, and freed
    memory goes back to the system at the end."""
    for name, drop in _HELD.items():
        if name != owner:
            drop()
    try:
        yield
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:  # C libraries other than glibc have none
            trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def new_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column
    (Spark compares column names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def check_free(df: DataFrame, *names: str) -> None:
    """Raise when an output column would clash with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    clash = [n for n in names if n.lower() in taken]
    if clash:
        raise ValueError(f"input already has column(s) {clash}; rename them or the output columns")


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The rows of ``df`` in one struct column, with columns of its own beside
    it: no name of ``df`` can clash with one that an operator adds."""
    return df.select(F.struct(*(col(c).alias(f"c{i}") for i, c in enumerate(df.columns))).alias("_packed"),
                     *(c.alias(name) for name, c in named.items()))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that :func:`packed` put away."""
    return rows.select(*(F.col(f"_packed.c{i}").alias(c) for i, c in enumerate(columns)))


def col(name: str):
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def slices(batch: pa.RecordBatch, max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``max_bytes`` at most (one
    row at least), which bounds the memory of what is made from it."""
    n = batch.num_rows
    if n == 0:
        return
    step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
    for at in range(0, n, step):
        yield batch.slice(at, step)


def word_bytes(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the
    ASCII white space of :data:`WORD`."""
    return text.encode("utf-8", "surrogatepass").split() if text else []
