"""Deterministic splits and resampling.

All splits are row-local: a row's side is a hash of its key and the seed, so
no shuffle or sort is needed, the result does not depend on partitioning
(stable under executor loss and re-execution) and the same split can be
computed in SQL.  The test fraction is therefore approximate, not exact.
Rows without key are never dropped: they are training rows, in one fold.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.frames import with_scalars
from tabkit.functions.prefix import ordered_prefix_sums
from tabkit.functions.scalar import HASH_SPACE, hash_bucket


def _need_seed(seed):
    if seed is None:
        raise ValueError("a seed is required: splits must be reproducible")
    return seed


def is_test_col(id_col: str, frac: float, seed: int):
    return hash_bucket(id_col, _need_seed(seed)) < F.lit(int(frac * HASH_SPACE))


def assign_split(df: DataFrame, id_col: str, frac: float = 0.25, seed: int | str | None = None,
                 out_col: str = "split") -> DataFrame:
    """Add ``split`` = 'test' for about ``frac`` of the keys, else 'train'."""
    return df.withColumn(out_col, F.when(is_test_col(id_col, frac, seed), "test").otherwise("train"))


def train_test_split(df: DataFrame, id_col: str, frac: float = 0.25,
                     seed: int | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test); the seed is mandatory for reproducibility."""
    t = is_test_col(id_col, frac, seed)
    return df.where(~t), df.where(t)


def k_fold(df: DataFrame, id_col: str, k: int = 5, seed: int | str | None = None,
           out_col: str = "fold") -> DataFrame:
    """Shuffled K-fold assignment, ``fold`` in 0..k-1 (seed required)."""
    return df.withColumn(out_col, (hash_bucket(id_col, _need_seed(seed)) % F.lit(k)).cast("int"))


def repeated_splits(df: DataFrame, id_col: str, n: int, frac: float = 0.25) -> DataFrame:
    """N independent splits with seeds 0..n-1: one row per (row, seed)
    with ``is_test``.  The n-fold row expansion is the operator's output."""
    seeded = df.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    key = F.concat(F.col(id_col).cast("string"), F.lit("-"), F.col("seed").cast("string"))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    bucket = F.coalesce(bucket, F.lit(HASH_SPACE - 1))  # as in hash_bucket
    return seeded.withColumn("is_test", bucket < F.lit(int(frac * HASH_SPACE)))


def tail_cut(df: DataFrame, order_col: str, frac: float = 0.2):
    """R2 helper: the smallest key (as a typed literal column, or None) of the
    last ``frac`` of rows in key order
    (validation = rows at 0-based position >= floor(n * (1 - frac))).

    Exact and distributed: counts per distinct key, running counts by the
    bucketed prefix-sum (no global window), then a one-row min aggregate.
    """
    counts = df.where(F.col(order_col).isNotNull()).groupBy(order_col).agg(F.count(F.lit(1)).alias("cnt"))
    pref = ordered_prefix_sums(counts, order_col, ["cnt"])
    n = counts.agg(F.sum("cnt")).first()[0] or 0
    split_at = int(math.floor(n * (1.0 - frac)))
    cut = F.min(order_col)
    kind = df.schema[order_col].dataType.simpleString()
    timed = kind in ("date", "timestamp", "timestamp_ntz")
    row = pref.where(F.col("cum_cnt") - F.col("cnt") >= F.lit(split_at)).agg(cut.cast("string") if timed else cut).first()
    return None if row[0] is None else F.lit(row[0]).cast(kind)


def tail_split(df: DataFrame, order_col: str, frac: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """R2: (train, validation) where the last ``frac`` of rows by ``order_col``
    validate.  The cut becomes a plain range filter that reaches the scan.
    Rows with equal keys are never split: a tie group straddling the
    boundary stays in training, so validation holds at most ``frac``; rows
    without key are training rows."""
    cut = tail_cut(df, order_col, frac)
    if cut is None:
        return df, df.limit(0)
    key = F.col(order_col)
    return df.where(key.isNull() | (key < cut)), df.where(key >= cut)


def class_weights(df: DataFrame, label: str, out_col: str = "weight") -> DataFrame:
    """Weight 1.0 for class 0 and n_neg / n_pos for class 1, computed in
    one aggregate row and attached by a one-row broadcast."""
    stats = df.agg(F.count_if(F.col(label) == 0).alias("__neg"),
                   F.count_if(F.col(label) == 1).alias("__pos"))
    w1 = F.try_divide(F.col("__neg").cast("double"), F.col("__pos").cast("double"))
    return (df.transform(with_scalars(stats))
            .withColumn(out_col, F.when(F.col(label) == 1, w1).otherwise(F.lit(1.0)))
            .drop("__neg", "__pos"))
