"""Small shared pieces for the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.sources.tables import table

# Fixed values shared by the Spark queries and their SQL oracles.
SEED = 42
TEST_FRAC = 0.25
TEST_CUT = 1073741824  # int(0.25 * 2**32)
ROUND = 6


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def r(col, n: int = ROUND) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, n)


def sql_bucket(id_expr: str, seed: int = SEED) -> str:
    """DuckDB twin of :func:`tabkit.functions.scalar.hash_bucket`."""
    return f"('0x' || substr(md5(cast({id_expr} AS VARCHAR) || '-{seed}'), 1, 8))::BIGINT"
