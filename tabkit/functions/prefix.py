"""Running (prefix) sums over an ordered key without a global window.

A ``Window.orderBy(key)`` with no partition moves every row into one task.
Here the key range is cut into buckets at approximate quantiles (a bounded
list of cut points, fitted in one pass), each bucket is ordered and summed in
its own task, and the small table of bucket totals (one row per bucket)
supplies each bucket's starting offset through a broadcast join.  Buckets
are balanced by construction because callers pass one row per distinct key
(pre-aggregated), so a hot key is a single row, never a hot task.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bkt"


def default_buckets(spark) -> int:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # two per shuffle partition: callers size the partitions to the data, so
    # the keys of one bucket stay bounded as the data grows
    return max(8, 2 * parts)


def _ordered_number(df: DataFrame, key: str) -> Column:
    """A double that rises with the key: numbers as they are, dates and
    timestamps as days or microseconds."""
    kind = df.schema[key].dataType.simpleString()
    if kind == "date":
        return F.unix_date(F.col(f"`{key}`")).cast("double")
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(f"`{key}`")).cast("double")
    return F.col(f"`{key}`").cast("double")


def add_buckets(df: DataFrame, keys: list[str], n_buckets: int | None = None,
                rel_err: float | None = None) -> tuple[DataFrame, list[str]]:
    """Add one order-preserving bucket column per key column.

    Cut points come from ``approxQuantile`` (one pass over ``df`` for all
    keys together; the driver receives ``n_buckets - 1`` doubles per key).
    Bucket ids are monotone non-decreasing in the key, which is all the
    prefix computation needs; exactness never depends on the cut points.
    """
    spark = df.sparkSession
    n_buckets = n_buckets or default_buckets(spark)
    rel_err = rel_err if rel_err is not None else 1.0 / (4 * n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    dbl = [f"_k{i}" for i in range(len(keys))]
    staged = df.withColumns({d: _ordered_number(df, k) for d, k in zip(dbl, keys)})
    cuts = staged.approxQuantile(dbl, probs, rel_err) if probs else [[] for _ in keys]
    splits = []
    for cut in cuts:
        inner = sorted({c for c in cut if c is not None and not math.isnan(c) and not math.isinf(c)})
        if not inner:  # empty or all-null key: a single effective bucket
            inner = [0.0]
        splits.append([-math.inf] + inner + [math.inf])
    outs = [f"{BUCKET}{i}" for i in range(len(keys))]
    bucketed = Bucketizer(splitsArray=splits, inputCols=dbl, outputCols=outs,
                          handleInvalid="keep").transform(staged)
    return bucketed.drop(*dbl), outs


BROADCAST_ROWS = 1_000_000


def prefix_sums_long(df: DataFrame, group_cols: list[str], key: str, weights: list[str],
                     bucket_col: str, descending: bool = False,
                     prefix: str = "cum_", broadcast_rows: int = BROADCAST_ROWS,
                     max_offsets: int | None = None) -> DataFrame:
    """Inclusive running sums of ``weights`` ordered by ``key`` within each
    group.  ``df`` holds one row per (group, key); ``bucket_col`` must be
    monotone in ``key`` within a group (see :func:`add_buckets`).

    Adds ``{prefix}{w}`` per weight column.  Two small pieces of state leave
    the row data: bucket totals (groups x buckets rows) and their offsets.
    ``max_offsets`` (groups x buckets, when the caller knows it) bounds the
    offsets table without a counting job.
    """
    order_key = F.col(key).desc() if descending else F.col(key).asc()
    order_bkt = F.col(bucket_col).desc() if descending else F.col(bucket_col).asc()
    totals = df.groupBy(*group_cols, bucket_col).agg(
        *[F.sum(w).alias(f"_tot_{w}") for w in weights])
    w_off = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy(order_bkt) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group_cols, bucket_col,
                            *[F.coalesce(F.sum(f"_tot_{w}").over(w_off), F.lit(0)).alias(f"_off_{w}")
                              for w in weights])
    w_in = Window.partitionBy(*group_cols, bucket_col).orderBy(order_key) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = df.select("*", *[F.sum(w).over(w_in).alias(f"_run_{w}") for w in weights])
    # offsets has (groups x buckets) rows: broadcast it when that count is
    # within ``broadcast_rows`` (checked on the small totals table), else an
    # ordinary shuffle join on (groups, bucket)
    if not group_cols:
        small = True
    elif max_offsets is not None:  # caller knows the bound: no counting job
        small = max_offsets <= broadcast_rows
    else:
        small = totals.count() <= broadcast_rows
    joined = running.join(F.broadcast(offsets) if small else offsets, [*group_cols, bucket_col])
    return joined.select(*df.columns,
                         *[(F.col(f"_run_{w}") + F.col(f"_off_{w}")).alias(f"{prefix}{w}")
                           for w in weights])


def ordered_prefix_sums(df: DataFrame, key: str, weights: list[str], descending: bool = False,
                        n_buckets: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Running sums over one global order of ``key`` (one row per key)."""
    bucketed, (bcol,) = add_buckets(df, [key], n_buckets)
    out = prefix_sums_long(bucketed, [], key, weights, bcol, descending, prefix)
    return out.drop(bcol)
