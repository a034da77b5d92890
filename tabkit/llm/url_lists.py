"""Temporal URL lists: every capture meets the entries active when it was
fetched.  DataFrame functions only.

A list is a table of dated entries: from ``listed_on`` on, the entry's ``key`` at
its ``level`` (``path``: host and first path segment, ``host``, or ``domain``: the
host's last two labels) has an ``action`` (``block``, ``allow``, or ``remove``, which
ends an earlier entry).  Entries become validity intervals, each up to the next
entry of its level and key, so at most one interval of a key holds at a time.
A capture is joined as of its fetch date at each level, and the most specific
level with an active entry decides.

Spark work: intervals are cut at the borders of fixed periods and joined by key
*and period*, so a host with a third of all captures is dealt out over its
periods (and a skewed rest is split by Spark's adaptive join, which can split
the capture side of these left joins).  Where the counted intervals are few
(``BROADCAST_ROWS``) they are broadcast and captures are not shuffled at all.
Each join keeps one row per capture; nothing is grouped again.

Results for odd input: a null or unparsable url has no keys and no entry; a
null fetch date meets no entry; entries without key, level or date are not
entries; of several entries of a key on one day ``block`` goes before ``allow``
before ``remove``; repeated captures are judged alike; empty tables give no
rows or no verdicts; other columns pass through, and an output name that
clashes with one of them is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.common import check_free, col

LEVELS = ("path", "host", "domain")
#: Interval slices up to this count are broadcast (some 100 bytes each).
BROADCAST_ROWS = 500_000
#: Days of one period.
PERIOD = 32


def url_keys(url: Column) -> dict[str, Column]:
    """The keys that an entry may name, per level; null where there is none."""
    some = lambda c: F.when(c != "", c)
    host = some(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)))
    segment = some(F.regexp_extract(url, r"^[^/?#]*://[^/?#]*/([^/?#]+)", 1))
    domain = F.coalesce(some(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)), host)
    return {"path": F.concat(host, F.lit("/"), segment), "host": host, "domain": domain}


def validity(entries: DataFrame) -> DataFrame:
    """``level``, ``key``, ``action``, ``listed_on`` and ``listed_to`` (the day
    from which the next entry of the key holds; null: still valid).  Removals
    end intervals and have none of their own."""
    rank = F.when(F.col("action") == "block", 0).when(F.col("action") == "allow", 1).otherwise(2)
    days = (entries.where("level is not null and key is not null and listed_on is not null")
            .groupBy("level", "key", "listed_on").agg(F.min_by("action", rank).alias("action")))
    following = F.lead("listed_on").over(Window.partitionBy("level", "key").orderBy("listed_on"))
    return days.withColumn("listed_to", following).where("action in ('block', 'allow')")


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD)


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """``captures`` with ``list_level``, ``list_action``, ``listed_on``,
    ``listed_to`` of the deciding entry (null where none holds) and
    ``blocked``."""
    check_free(captures, "list_level", "list_action", "listed_on", "listed_to", "blocked", "_period",
               *(f"_{x}_{level}" for level in LEVELS for x in ("key", "entry")))
    out = captures.withColumns({f"_key_{level}": k for level, k in url_keys(col(url)).items()}
                               | {"_period": _period(col(fetched_on))})
    last = captures.agg(F.max(_period(col(fetched_on)))).first()[0]
    ends = F.coalesce(_period(F.date_sub("listed_to", 1)), F.lit(last))
    slices = (validity(entries).where(_period(F.col("listed_on")) <= F.lit(last))
              .withColumn("_period", F.explode(F.sequence(_period(F.col("listed_on")), F.least(ends, F.lit(last))))))
    small = slices.count() <= BROADCAST_ROWS
    for level in LEVELS:
        key, entry = f"_key_{level}", f"_entry_{level}"
        side = slices.where(F.col("level") == level).select(
            F.col("key").alias("_k"), F.col("_period").alias("_p"),
            F.struct("level", "action", "listed_on", "listed_to").alias(entry))
        active = ((F.col(key) == F.col("_k")) & (F.col("_period") == F.col("_p"))
                  & (col(fetched_on) >= F.col(f"{entry}.listed_on"))
                  & (F.col(f"{entry}.listed_to").isNull() | (col(fetched_on) < F.col(f"{entry}.listed_to"))))
        out = out.join(F.broadcast(side) if small else side, active, "left").drop("_k", "_p")
    found = F.coalesce(*(F.col(f"_entry_{level}") for level in LEVELS))
    return out.select(*(col(c) for c in captures.columns), found["level"].alias("list_level"),
                      found["action"].alias("list_action"), found["listed_on"].alias("listed_on"),
                      found["listed_to"].alias("listed_to"),
                      F.coalesce(found["action"] == "block", F.lit(False)).alias("blocked"))
