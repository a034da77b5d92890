"""Incremental, resumable ingest (S6) and landed API pages.

The ingest is idempotent: the rows to append are the delivery minus every
key already held (a left anti join against the target), with duplicates
inside one delivery removed.  Re-running a batch after a failure therefore
appends nothing twice -- the file commit protocol makes each append
all-or-nothing, and the anti join skips whatever a previous attempt did
commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.sources.io import path_exists


def dedupe_delivery(new: DataFrame, id_col: str, order_col: str | None = None) -> DataFrame:
    """One row per key.  With ``order_col`` the latest copy wins (largest
    value; remaining ties by the largest row); without it the copies are
    expected to be identical and any one is kept.

    Both forms are hash aggregates with a map-side partial step, so a key
    delivered millions of times is reduced inside each task before the
    shuffle (never sorted in one task)."""
    if order_col is None:
        return new.dropDuplicates([id_col])
    others = [c for c in new.columns if c not in (id_col, order_col)]
    best = F.max(F.struct(F.col(order_col).alias("__o"), *[F.col(f"`{c}`") for c in others]))
    return (new.groupBy(id_col).agg(best.alias("__b"))
            .select(id_col, F.col("__b.__o").alias(order_col), *[F.col(f"__b.`{c}`").alias(c) for c in others])
            .select(*new.columns))


def split_keyed(new: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without): the latter can neither be deduplicated
    nor recognised on a replay, so they are bad records, as in S3."""
    key = F.col(f"`{id_col}`")
    return new.where(key.isNotNull()), new.where(key.isNull())


def ingest_incremental(new: DataFrame, existing: DataFrame | None, id_col: str,
                       resume_from=None, order_col: str | None = None) -> DataFrame:
    """S6 (batch): the rows of ``new`` to append to ``existing``.  Rows without
    key are not among them (see :func:`split_keyed`).

    * keys already held are skipped (left anti join; ``existing`` is only
      read for its key column),
    * with ``resume_from`` only keys >= the resume point are kept (a range
      predicate that reaches the scan),
    * duplicates inside the delivery collapse to one row.
    """
    rows, _ = split_keyed(new, id_col)
    if resume_from is not None:
        rows = rows.where(F.col(id_col) >= F.lit(resume_from))
    rows = dedupe_delivery(rows, id_col, order_col)
    if existing is not None:
        rows = rows.join(existing.select(id_col), id_col, "left_anti")
    return rows


def append_new(spark: SparkSession, new: DataFrame, target_path: str, id_col: str,
               resume_from=None, order_col: str | None = None, fmt: str = "parquet",
               bad_path: str | None = None) -> int:
    """S6 sink: append the unseen rows of ``new`` to the table at
    ``target_path`` (created on first use).  Returns the number appended.

    Rows without key go to ``bad_path`` (default: ``target_path`` with
    ``-without-key``), once each: a row that is there already is not added
    again, so a replay adds nothing.  A target that exists but cannot be read
    is an error, not a first delivery."""
    bad_path = bad_path or f"{target_path.rstrip('/')}-without-key"

    def add(rows: DataFrame, path: str, held: DataFrame | None) -> int:
        if held is not None:
            # the new rows must be computed before the append changes the
            # target under the anti join; cut the lineage with a checkpoint in
            # the shared checkpoint folder (reliable, survives executor loss)
            rows = rows.checkpoint(eager=True)
        n = rows.count()
        if n:
            rows.write.mode("append").format(fmt).save(path)
        return n

    def held_at(path: str) -> DataFrame | None:
        return spark.read.format(fmt).load(path) if path_exists(spark, path) else None

    held_bad = held_at(bad_path)
    bad = split_keyed(new, id_col)[1].distinct()
    add(bad if held_bad is None else bad.subtract(held_bad.select(*new.columns)), bad_path, held_bad)
    existing = held_at(target_path)
    return add(ingest_incremental(new, existing, id_col, resume_from, order_col), target_path, existing)


# ---------------------------------------------------------------------------
# S7 landed response pages
# ---------------------------------------------------------------------------
def explode_pages(pages: DataFrame, page_col: str, body_col: str, item_schema,
                  data_key: str = "data",
                  rate_limit_pattern: str = "(?i)rate.?limit|too many requests",
                  rate_limit_key: str = "X-RateLimit-Exceeded") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Landed API response pages -> (items, page_stats, errors).

    A page is a JSON object; pages holding a ``data`` array yield one row per
    element (``page``, ``position``, item fields); ``page_stats`` counts
    items per page; every other page (unparseable, no ``data``, a rate-limit
    message, or an object with the key ``rate_limit_key``, whatever else it
    holds) goes to ``errors`` with a ``kind``.
    """
    item_t = item_schema if isinstance(item_schema, T.DataType) else T._parse_datatype_string(item_schema)
    env = T.StructType([T.StructField(data_key, T.ArrayType(item_t), True),
                        T.StructField("message", T.StringType(), True),
                        T.StructField("error", T.StringType(), True)])
    parsed = pages.select(F.col(page_col).alias("page"), F.col(body_col).alias("body"),
                          F.from_json(F.col(body_col), env).alias("p"))
    keys = F.json_object_keys(F.col("body"))
    limited = F.coalesce(F.array_contains(keys, rate_limit_key), F.lit(False))
    has_data = F.col(f"p.{data_key}").isNotNull() & ~limited
    ok = parsed.where(has_data)
    items = ok.select("page", F.posexplode(f"p.{data_key}").alias("position", "item")).select(
        "page", "position", "item.*")
    stats = ok.select("page", F.size(f"p.{data_key}").alias("n_items"))
    text = F.coalesce(F.col("p.message"), F.col("p.error"), F.col("body"))
    errors = parsed.where(~has_data).select(
        "page",
        F.when(keys.isNull(), F.lit("unparseable"))
         .when(limited | text.rlike(rate_limit_pattern), F.lit("rate_limited"))
         .otherwise(F.lit("error")).alias("kind"),
        text.alias("detail"))
    return items, stats, errors
