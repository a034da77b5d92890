"""Every registered query against its DuckDB oracle (or, without one, that it
runs and returns rows), at a small scale factor."""

import pytest

from tabkit.plans.check import compare, duckdb_conn
from tabkit.plans.registry import all_queries

QUERIES = all_queries()
SQL_NAMES = sorted(n for n, q in QUERIES.items() if q.sql)
# model queries are covered with their invariants in test_models.py
ROWS_ONLY = sorted(n for n, q in QUERIES.items() if not q.sql)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb_conn(sf_dir)
    yield c
    c.close()


@pytest.mark.parametrize("name", SQL_NAMES)
def test_matches_oracle(spark, con, sf_dir, name):
    res = compare(spark, con, QUERIES[name], sf_dir)
    assert res["status"] == "ok", res


def test_every_operator_family_registered():
    ops = {o for q in QUERIES.values() for o in q.operators}
    families = {"S", "P", "M", "E", "N", "R", "A", "T", "J", "V", "L", "K"}
    assert families <= {o[0] for o in ops}


def test_entry_points(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(qs)


def test_coverage_table_complete():
    import importlib
    import re
    from tabkit.plans.coverage import FUNCTIONS
    ops = {o for q in QUERIES.values() for o in q.operators}
    assert set(FUNCTIONS) <= ops, sorted(set(FUNCTIONS) - ops)
    for spec in FUNCTIONS.values():
        for part in re.split(r"[;/]", spec):
            part = part.strip()
            if not part:
                continue
            if part.startswith(("operators.", "sources.", "streaming.")):
                mod, fn = part.rsplit(".", 1) if "(" not in part else part.split("(")[0].rsplit(".", 1)
                module = importlib.import_module(f"tabkit.{mod}")
            else:  # "name" continuing the previous module
                fn = part.split("(")[0]
            assert hasattr(module, fn), (spec, fn)
