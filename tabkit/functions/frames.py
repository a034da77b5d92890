"""Attaching fitted scalars to rows.

Many operators need a handful of global statistics (a mean, a total, a
min/max pair) next to every row.  They are computed as one global
aggregate (partial per task, one tiny merge), fetched as a single row --
the same "fit" step as any estimator -- and attached as typed literals in a
projection.  No join is planned at all, so there is no pairing of rows and
nothing data-sized reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tables of fewer rows keep their partitions.
DEAL_ROWS = 100_000
#: Rows of a partition, where the table has enough of them for all cores.
TASK_ROWS = 1_000_000


def fetch_row(one_row: DataFrame) -> dict[str, Column]:
    """Run a global aggregate and return its single row as typed literals."""
    rows = one_row.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected exactly one row of statistics, got {len(rows)}")
    types = {f.name: f.dataType for f in one_row.schema.fields}
    return {k: F.lit(v).cast(types[k]) for k, v in rows[0].asDict().items()}


def with_scalars(stats: DataFrame | Mapping[str, Column]) -> Callable[[DataFrame], DataFrame]:
    """``df.transform(with_scalars(stats))`` adds every column of the
    one-row ``stats`` (or of an already fetched mapping) to each row of
    ``df``."""
    values = stats if isinstance(stats, Mapping) else None

    def attach(df: DataFrame) -> DataFrame:
        nonlocal values
        if values is None:
            values = fetch_row(stats)
        return df.withColumns(dict(values))
    return attach


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the shared folder named by ``spark.checkpoint.dir`` (survives executor
    loss; a local scratch folder is set only when none is configured).  Used
    for intermediates read by several branches of one plan, so the source
    is scanned and shuffled once instead of once per branch."""
    from tabkit.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def dealt_rows(df: DataFrame, least: int | None = None) -> Iterator[DataFrame]:
    """``df`` for a fit that passes over it many times: computed once, held
    inside the ``with``, and from ``least`` rows on (default ``DEAL_ROWS``)
    dealt evenly over all cores.  A file of one row group, a join or a cache
    may leave nearly all rows in one partition, and then every pass would run
    on one core.  Rows are dealt in turn, so repeated or null keys do not
    matter."""
    least = DEAL_ROWS if least is None else least
    own = not (df.storageLevel.useMemory or df.storageLevel.useDisk)  # else its owner releases it
    held = df.persist(StorageLevel.MEMORY_AND_DISK_DESER) if own else df
    try:
        n = held.count()
        if n < least:
            yield held
            return
        most = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / TASK_ROWS))
        rows = held.repartition(most).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        try:
            rows.count()
            if own:
                held.unpersist()
            yield rows
        finally:
            rows.unpersist()
    finally:
        if own:
            held.unpersist()
