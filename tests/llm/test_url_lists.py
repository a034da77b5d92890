"""Temporal lists: oracle parity and a plain walk over the entries."""

import datetime as dt
import random

import pytest

from tabkit.llm import url_lists as U
from tabkit.llm.queries import all_queries
from tabkit.plans.check import compare, duckdb_conn

DAY = dt.date(2024, 1, 1)


def test_query_matches_oracle(spark, sf_dir):
    con = duckdb_conn(sf_dir)
    assert compare(spark, con, all_queries()["op7_temporal_url_list"], sf_dir)["status"] == "ok"
    con.close()


def plain(captures, entries):
    order = {"block": 0, "allow": 1}
    out = []
    for url, day in captures:
        host = url.split("://")[1].split("/")[0] if url and "://" in url else None
        rest = url.split("://")[1].split("/")[1:] if host else []
        keys = {"path": f"{host}/{rest[0]}" if rest and rest[0] else None, "host": host,
                "domain": ".".join(host.split(".")[-2:]) if host else None}
        verdict = None
        for level in ("path", "host", "domain"):
            past = [(e[3], -order.get(e[2], 2), e[2]) for e in entries
                    if e[0] == level and e[1] == keys[level] and e[1] and e[3] and day and e[3] <= day]
            if past and max(past)[2] != "remove":
                verdict = (level, max(past)[2])
                break
        out.append((url, day, *(verdict or (None, None))))
    return out


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_against_a_plain_walk(spark, monkeypatch, broadcast):
    monkeypatch.setattr(U, "BROADCAST_ROWS", broadcast)
    rng = random.Random(4)
    hosts = ["a.x.com", "b.x.com", "x.com", "y.org", "solo"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/p/1", "/q")] + [None, "", "no url", "mailto:x"]
    days = [DAY + dt.timedelta(d) for d in range(0, 200, 3)]
    captures = [(rng.choice(urls), rng.choice(days + [None])) for _ in range(400)] + [("http://x.com/p/1", DAY)] * 3
    keys = [("host", h) for h in hosts] + [("domain", "x.com"), ("domain", "y.org"), ("domain", "solo")] + [
        ("path", f"{h}/{p}") for h in hosts for p in "pq"]
    entries = [(*rng.choice(keys), rng.choice(["block", "allow", "remove"]), rng.choice(days)) for _ in range(60)]
    entries += [("host", None, "block", DAY), (None, "x.com", "block", DAY), ("host", "x.com", "block", None)] + entries[:5]
    c = spark.createDataFrame(captures, "url string, fetched_on date").withColumn("Key", U.F.lit(1))
    e = spark.createDataFrame(entries, "level string, key string, action string, listed_on date")
    got = U.judge(c, e).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    rows = sorted([(r.url, r.fetched_on, r.list_level, r.list_action) for r in got], key=key)
    assert rows == sorted(plain(captures, entries), key=key)
    assert all(r.blocked == (r.list_action == "block") for r in got)


def test_empty_and_clashes(spark):
    c = spark.createDataFrame([("http://x.com", DAY)], "url string, fetched_on date")
    e = spark.createDataFrame([("host", "x.com", "block", DAY)], "level string, key string, action string, listed_on date")
    assert U.judge(c.limit(0), e).count() == 0
    assert [r.blocked for r in U.judge(c, e.limit(0)).collect()] == [False]
    assert [r.blocked for r in U.judge(c, e).collect()] == [True]
    with pytest.raises(ValueError):
        U.judge(c.withColumn("Blocked", U.F.lit(1)), e)
