"""Oracle comparison: run a registered query in Spark and its SQL in DuckDB
over the same parquet files and compare row count, column names and an
order-insensitive multiset of rounded row values."""

from __future__ import annotations

import math
import sys
import time

from tabkit.sources.tables import TABLES


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, q, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    res = {"name": q.name, "spark_sec": round(t1 - t0, 2), "rows": len(s_rows)}
    if q.sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(q.sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={sorted(s_cols)} sql={sorted(d_cols)}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        res["status"] = f"ROWCOUNT spark={len(a)} sql={len(b)}"
        return res
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"VALUES {diff}"
        return res
    res["status"] = "ok"
    return res


def main(argv=None):
    argv = argv if argv is not None else sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
    from tabkit.plans.registry import all_queries
    from tabkit.session import get_session
    spark = get_session(shuffle_partitions=8)
    con = duckdb_conn(sf_dir)
    qs = all_queries()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        try:
            res = compare(spark, con, q, sf_dir)
        except Exception as e:  # report and continue
            res = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        ok = res["status"] in ("ok", "rows-only")
        bad += not ok
        print(("PASS " if ok else "FAIL ") + str(res), flush=True)
    print(f"{len(qs) if not names else len(names)} queries, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
