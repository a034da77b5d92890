"""Registered queries: every operator family exercised over the driver
tables, each with its DuckDB oracle where one can be written."""

from tabkit.plans.registry import QUERIES, Query, all_queries, query

__all__ = ["QUERIES", "Query", "all_queries", "query"]
