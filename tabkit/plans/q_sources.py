"""Registered queries: sources and sinks (S1-S8) and the streaming ingest.

Each query lands data derived from a driver table in a fresh folder under
the session's checkpoint directory (shared storage on a cluster), reads it
back through the operator under test and returns what it read, so the
oracle compares the round trip with the source table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators.metrics import regression_metrics
from tabkit.operators.split import k_fold
from tabkit.plans.common import SEED, t
from tabkit.plans.registry import query
from tabkit.sources import ingest as I
from tabkit.sources import io as S

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
EVENT_SCHEMA = "event_id bigint, event_type string, value double"


@query("read_table", "S1", sql="""
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment
FROM customer""")
def q_read_table(spark, sf):
    c = t(spark, sf, "customer")
    landed = c.select("c_custkey", "c_name", "c_nationkey",
                      F.when(F.col("c_acctbal") < 0, F.lit("null"))
                       .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
                      F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("NA"))
                       .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    path = S.write_table(landed, S.scratch_dir(spark, "s1-customer"))
    return S.read_table(spark, path, CUSTOMER_SCHEMA)


@query("read_records", "S2", sql="""
SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_read_records(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type", "value",
                                       F.from_json("props", "k bigint").alias("props"))
    path = S.scratch_dir(spark, "s2-events")
    ev.write.json(path)
    rec = S.read_records(spark, path, EVENT_SCHEMA + ", props struct<k: bigint>")
    return rec.select("event_id", "event_type", "value", F.col("props.k").alias("k"))


def _landed_mixed(spark, sf):
    """Events as JSON text lines: errors land as a bare JSON string (not an
    object), signups without their id, everything else as a full object."""
    ev = t(spark, sf, "events")
    line = (F.when(F.col("event_type") == "error", F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
            .when(F.col("event_type") == "signup", F.to_json(F.struct("event_type", "value")))
            .otherwise(F.to_json(F.struct("event_id", "event_type", "value"))))
    path = S.scratch_dir(spark, "s3-events")
    ev.select(line.alias("value")).write.text(path)
    return S.read_records(spark, path, EVENT_SCHEMA)


@query("split_valid_good", "S3,S2", sql="""
SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'signup')""")
def q_split_valid_good(spark, sf):
    good, _ = S.split_valid(_landed_mixed(spark, sf), "event_id")
    return good


@query("split_valid_bad", "S3", sql="""
SELECT CASE event_type WHEN 'error' THEN 'not_an_object' ELSE 'missing_id' END AS reason, count(*) AS n
FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1""")
def q_split_valid_bad(spark, sf):
    _, bad = S.split_valid(_landed_mixed(spark, sf), "event_id")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("write_predictions", "S4,S1", sql="""
SELECT o_orderkey, o_totalprice / 1000 AS prediction FROM orders""")
def q_write_predictions(spark, sf):
    preds = t(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("prediction"))
    path = S.write_predictions(preds, S.scratch_dir(spark, "s4-preds"), "o_orderkey", "prediction")
    return S.read_table(spark, path, "o_orderkey bigint, prediction double")


@query("rewrite_table", "S5,P2,P6", sql="""
SELECT c_custkey, c_acctbal, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS is_building FROM customer""")
def q_rewrite_table(spark, sf):
    from tabkit.operators.columns import drop_columns, flag
    base = S.scratch_dir(spark, "s5-features")
    S.rewrite_table(t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), base)
    step = S.read_current(spark, base)
    S.rewrite_table(flag(step, "is_building", F.col("c_mktsegment") == "BUILDING"), base)
    step = S.read_current(spark, base)
    S.rewrite_table(drop_columns(step, ["c_mktsegment"]), base)
    return S.read_current(spark, base)


@query("ingest_incremental", "S6,J2", sql="""
SELECT event_id, event_type, value FROM events""")
def q_ingest_incremental(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type", "value")
    target = S.scratch_dir(spark, "s6-target")
    # rows already held: the 'view' events
    ev.where(F.col("event_type") == "view").write.parquet(target)
    # the delivery: every event, with the clicks delivered twice
    delivery = ev.unionByName(ev.where(F.col("event_type") == "click"))
    I.append_new(spark, delivery, target, "event_id")
    # a replay of the same delivery (restart after a failure) adds nothing
    I.append_new(spark, delivery, target, "event_id")
    return spark.read.parquet(target)


@query("ingest_stream", "S6", sql="""
SELECT event_id, event_type, value FROM events""")
def q_ingest_stream(spark, sf):
    from tabkit.streaming.ingest import ingest_stream, read_ingested
    ev = t(spark, sf, "events").select("event_id", "event_type", "value")
    landing = S.scratch_dir(spark, "s6s-landing")
    # rows held before the stream starts: the 'view' events
    held = S.scratch_dir(spark, "s6s-held")
    ev.where(F.col("event_type") == "view").write.parquet(held)
    # two deliveries land as files; the second repeats the first one's rows
    ev.where(F.col("event_type").isin("click", "signup")).write.json(f"{landing}/d1")
    ev.write.json(f"{landing}/d2")
    target = S.scratch_dir(spark, "s6s-target")
    q = ingest_stream(spark, f"{landing}/*", EVENT_SCHEMA, target, S.scratch_dir(spark, "s6s-ckpt"),
                      "event_id", existing_path=held, max_files_per_trigger=4)
    q.awaitTermination()
    return read_ingested(spark, target).unionByName(spark.read.parquet(held))


PAGE_SIZE = 20


def _conversation_pages(spark, sf):
    """Conversations landed as API pages of at most PAGE_SIZE turns (page id
    ``conv_id-n``), the turns under ``data``; a page holding a system turn
    landed as a rate-limit response instead.  Pages are bounded groups
    whatever the length of a conversation."""
    conv = t(spark, sf, "conversations")
    page = F.concat(F.col("conv_id").cast("string"), F.lit("-"),
                    F.floor(F.col("turn") / PAGE_SIZE).cast("string"))
    per = conv.groupBy(page.alias("page_no")).agg(
        F.max((F.col("role") == "system").cast("int")).alias("limited"),
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("data"))
    body = F.when(F.col("limited") == 1,
                  F.to_json(F.struct(F.lit("Rate limit exceeded, retry later").alias("message"))))\
        .otherwise(F.to_json(F.struct("data")))
    return per.select("page_no", body.alias("body"))


_ITEM = "struct<turn: bigint, role: string, text: string>"
_PAGED = f"""(SELECT *, CAST(conv_id AS VARCHAR) || '-' || CAST(turn // {PAGE_SIZE} AS VARCHAR) AS page
   FROM conversations)"""
_PAGES_OK = f"page NOT IN (SELECT page FROM {_PAGED} WHERE role = 'system')"


@query("explode_pages_items", "S7", sql=f"""
SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY turn) - 1 AS INTEGER) AS position,
       turn, role, text
FROM {_PAGED} WHERE {_PAGES_OK}""")
def q_explode_pages_items(spark, sf):
    items, _, _ = I.explode_pages(_conversation_pages(spark, sf), "page_no", "body", _ITEM)
    return items


@query("explode_pages_stats", "S7", sql=f"""
SELECT page, CAST(count(*) AS INTEGER) AS n_items FROM {_PAGED} WHERE {_PAGES_OK} GROUP BY page""")
def q_explode_pages_stats(spark, sf):
    _, stats, _ = I.explode_pages(_conversation_pages(spark, sf), "page_no", "body", _ITEM)
    return stats


@query("explode_pages_errors", "S7", sql=f"""
SELECT DISTINCT page, 'rate_limited' AS kind, 'Rate limit exceeded, retry later' AS detail
FROM {_PAGED} WHERE NOT ({_PAGES_OK})""")
def q_explode_pages_errors(spark, sf):
    _, _, errors = I.explode_pages(_conversation_pages(spark, sf), "page_no", "body", _ITEM)
    return errors


@query("log_metrics", "S8,K1,K2,K3,R3", sql=f"""
WITH f AS (
  SELECT CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-{SEED}'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold,
         l_extendedprice AS y, l_quantity * p_retailprice AS p
  FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT fold, round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 4) AS mse,
             round(sqrt(avg((y - p) * (y - p))), 6) AS rmse FROM f GROUP BY fold)
SELECT 'cv' AS run_id, fold, 'mae' AS metric, mae AS value FROM m
UNION ALL SELECT 'cv', fold, 'mse', mse FROM m
UNION ALL SELECT 'cv', fold, 'rmse', rmse FROM m""")
def q_log_metrics(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    part = t(spark, sf, "part").select("p_partkey", "p_retailprice")
    d = li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("p"))
    m = regression_metrics(k_fold(d, "l_orderkey", 5, SEED), "y", "p", ["fold"])
    m = m.select("fold", F.round("mae", 6).alias("mae"), F.round("mse", 4).alias("mse"),
                 F.round("rmse", 6).alias("rmse"))
    path = S.scratch_dir(spark, "s8-metrics")
    S.log_metrics(m, path, "cv", ["fold"], ["mae", "mse", "rmse"])
    return spark.read.parquet(path)


@query("ingest_indexed", "S6,J2", sql="""
SELECT event_id, event_type, value FROM events""")
def q_ingest_indexed(spark, sf):
    """The incremental ingest against an index of the held keys: held events,
    then all, with the clicks twice, then a replay."""
    from tabkit.sources.keyindex import append_indexed
    ev = t(spark, sf, "events").select("event_id", "event_type", "value")
    target = S.scratch_dir(spark, "s6i-target")
    append_indexed(spark, ev.where(F.col("event_type") == "view"), target, "event_id")
    delivery = ev.unionByName(ev.where(F.col("event_type") == "click"))
    append_indexed(spark, delivery, target, "event_id")
    append_indexed(spark, delivery, target, "event_id")
    return spark.read.parquet(target)
