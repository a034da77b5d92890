"""Registry of end-to-end queries over the driver tables.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL (or ``None`` where no SQL form exists, e.g. model
training), so the same list drives ``__spark_entry__``, the oracle tests and
the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: tuple[str, ...]
    bench: bool


QUERIES: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None, bench: bool = False):
    """Register ``fn`` under ``name``; ``ops`` lists the SURVEY ids covered."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql.strip() if sql else None,
                              tuple(o.strip() for o in ops.split(",")), bench)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # importing the modules registers their queries
    from tabkit.plans import (q_columns, q_encode, q_metrics, q_models,  # noqa: F401
                              q_profile, q_similar, q_sources)
    return QUERIES
