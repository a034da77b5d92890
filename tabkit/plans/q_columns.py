"""Registered queries: the feature slice, projections (P), missing data (M),
scaling (N) and splits (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators import columns as P
from tabkit.operators import encode as E
from tabkit.operators import missing as M
from tabkit.operators import scale as N
from tabkit.operators import split as R
from tabkit.plans.common import SEED, TEST_CUT, TEST_FRAC, r, sql_bucket, t
from tabkit.plans.registry import query

B_L = sql_bucket("l_orderkey")
B_O = sql_bucket("o_orderkey")


def _lineitem_nulls(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.withColumns({"l_discount": F.expr("nullif(l_discount, 0.0)"),
                           "l_returnflag": F.expr("nullif(l_returnflag, 'R')")})


# ---------------------------------------------------------------------------
# the end-to-end slice: split -> fit on train -> impute, one-hot, standardise
# -> join orders -> per-split summary
# ---------------------------------------------------------------------------
@query("feature_slice", "P1,R1,M3,E3,N2,J1", bench=True, sql=f"""
WITH li AS (
  SELECT l_orderkey, l_extendedprice, nullif(l_discount, 0.0) AS l_discount, l_returnflag,
         CASE WHEN {B_L} < {TEST_CUT} THEN 'test' ELSE 'train' END AS split
  FROM lineitem),
tr AS (SELECT avg(l_discount) AS m_d, avg(l_extendedprice) AS m_p, stddev_pop(l_extendedprice) AS s_p
       FROM li WHERE split = 'train')
SELECT li.split, count(*) AS n_rows,
       CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS l_returnflag_A,
       CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS l_returnflag_N,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS l_returnflag_R,
       round(avg(coalesce(l_discount, tr.m_d)), 6) AS mean_discount,
       round(avg((l_extendedprice - tr.m_p) / tr.s_p), 6) AS mean_price_z,
       round(avg(CASE WHEN o.o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS fulfilled_rate
FROM li CROSS JOIN tr JOIN orders o ON li.l_orderkey = o.o_orderkey
GROUP BY li.split
""")
def feature_slice(spark, sf):
    li = P.select_features(t(spark, sf, "lineitem"),
                           ["l_orderkey", "l_extendedprice", "l_discount", "l_returnflag"])
    li = li.withColumn("l_discount", F.expr("nullif(l_discount, 0.0)"))
    li = R.assign_split(li, "l_orderkey", TEST_FRAC, SEED)
    train = li.where(F.col("split") == "train")
    # statistics are fitted on the training side only (no join needed for
    # it): the imputer's mean and the scaler's mean / population std come
    # from ONE aggregate pass, the one-hot levels from one distinct
    # the two fits are independent jobs: submitted together, Spark runs them
    # side by side
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=2) as pool:
        moments = pool.submit(N.fit_moments, train, ["l_discount", "l_extendedprice"])
        levels = pool.submit(E.fit_one_hot, train, ["l_returnflag"])
        means, stds = moments.result()
        oh = levels.result()
    imp = M.ImputerParams({"l_discount": means["l_discount"]})
    std = N.StandardParams({"l_extendedprice": means["l_extendedprice"]},
                           {"l_extendedprice": stds["l_extendedprice"] or 1.0})
    feats = E.apply_one_hot(N.apply_standard(M.apply_imputer(li, imp), std), oh)
    orders = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    joined = feats.join(orders, feats.l_orderkey == orders.o_orderkey)
    return joined.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(c).cast("bigint").alias(c) for c in oh.names["l_returnflag"]],
        r(F.avg("l_discount")).alias("mean_discount"),
        r(F.avg("l_extendedprice")).alias("mean_price_z"),
        r(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0))).alias("fulfilled_rate"))


# ---------------------------------------------------------------------------
# P: projections and scalar functions
# ---------------------------------------------------------------------------
@query("select_features", "P1", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem""")
def q_select_features(spark, sf):
    return P.select_features(t(spark, sf, "lineitem"),
                             ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@query("drop_columns", "P2", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def q_drop_columns(spark, sf):
    return P.drop_columns(t(spark, sf, "orders"), ["o_orderdate", "o_orderpriority"])


@query("columns_by_type", "P3", sql="SELECT p_partkey, p_size, p_retailprice FROM part")
def q_columns_by_type(spark, sf):
    return P.select_by_type(t(spark, sf, "part"), ["numeric"])


@query("columns_by_prefix", "P4", sql="SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem")
def q_columns_by_prefix(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("l_orderkey", *P.columns_by_prefix(li, "l_line"))


@query("binary_columns", "P5", sql="""
SELECT 'doc_id' AS "column", bool_and(doc_id IS NOT NULL AND doc_id IN (0, 1)) AS is_binary FROM labels
UNION ALL SELECT 'quality', bool_and(quality IS NOT NULL AND quality IN (0, 1)) FROM labels
UNION ALL SELECT 'toxic', bool_and(toxic IS NOT NULL AND toxic IN (0, 1)) FROM labels""")
def q_binary_columns(spark, sf):
    return P.binary_columns(t(spark, sf, "labels"))


@query("flag", "P6", sql="""
SELECT l_orderkey, l_linenumber,
       CAST(coalesce(l_discount > 0.05 AND l_quantity > 25, false) AS INTEGER) AS bulk_discount
FROM lineitem""")
def q_flag(spark, sf):
    li = t(spark, sf, "lineitem")
    out = P.flag(li, "bulk_discount", (F.col("l_discount") > 0.05) & (F.col("l_quantity") > 25))
    return out.select("l_orderkey", "l_linenumber", "bulk_discount")


@query("cast_flags", "P7", sql="""
WITH f AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS is_fulfilled,
                  CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent FROM orders)
SELECT 'is_fulfilled' AS "column", CAST(sum(is_fulfilled) AS BIGINT) AS ones,
       round(sum(is_fulfilled) / count(*) * 100, 4) AS pct FROM f
UNION ALL
SELECT 'is_urgent', CAST(sum(is_urgent) AS BIGINT), round(sum(is_urgent) / count(*) * 100, 4) FROM f""")
def q_cast_flags(spark, sf):
    o = t(spark, sf, "orders").select((F.col("o_orderstatus") == "F").alias("is_fulfilled"),
                                      (F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"))
    o = P.cast_flags(o, ["is_fulfilled", "is_urgent"], "int")
    return P.flag_shares(o, ["is_fulfilled", "is_urgent"])


@query("clip", "P8", sql="""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity IS NOT NULL THEN least(greatest(l_quantity, 5.0), 45.0) END AS l_quantity,
       CASE WHEN nullif(l_discount, 0.0) IS NOT NULL
            THEN least(greatest(nullif(l_discount, 0.0), 0.02), 0.08) END AS l_discount
FROM lineitem""")
def q_clip(spark, sf):
    li = _lineitem_nulls(spark, sf)
    out = P.clip(li, {"l_quantity": (5.0, 45.0), "l_discount": (0.02, 0.08)})
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("log1p", "P9", sql="""
SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_totalprice FROM orders""")
def q_log1p(spark, sf):
    o = P.log1p_columns(t(spark, sf, "orders"), ["o_totalprice"], suffix="_log")
    return o.select("o_orderkey", r("o_totalprice_log").alias("log_totalprice"))


# title case restarts after every character that is not a letter
_TITLE = ("array_to_string(list_transform(range(1, length({x}) + 1), lambda i: CASE "
          "WHEN i = 1 OR NOT regexp_matches(substr({x}, i - 1, 1), '\\p{{L}}') "
          "THEN upper(substr(replace({x}, '_', ' '), i, 1)) ELSE lower(substr(replace({x}, '_', ' '), i, 1)) END), '')")


@query("column_names", "P10", sql=f"""
WITH v AS (SELECT DISTINCT o_orderpriority AS value FROM orders
           UNION SELECT DISTINCT p_type FROM part),
n AS (SELECT value, translate(lower(value), ' /', '__') AS name FROM v)
SELECT value, name, {_TITLE.format(x='name')} AS label FROM n""")
def q_column_names(spark, sf):
    v = (t(spark, sf, "orders").select(F.col("o_orderpriority").alias("value"))
         .union(t(spark, sf, "part").select(F.col("p_type").alias("value"))).distinct())
    n = v.select("value", P.to_column_name("value").alias("name"))
    return n.select("value", "name", P.to_label("name").alias("label"))


@query("threshold", "P11", sql="""
SELECT event_id, CAST(value / 40.0 > 0.5 AS INTEGER) AS pred FROM events""")
def q_threshold(spark, sf):
    ev = t(spark, sf, "events").withColumn("score", F.col("value") / 40.0)
    return P.threshold(ev, "score", 0.5, "int", out_col="pred").select("event_id", "pred")


@query("drop_missing", "P12", sql="""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE nullif(l_discount, 0.0) IS NOT NULL AND nullif(l_returnflag, 'R') IS NOT NULL""")
def q_drop_missing(spark, sf):
    return P.drop_missing(_lineitem_nulls(spark, sf), ["l_discount", "l_returnflag"]) \
        .select("l_orderkey", "l_linenumber")


@query("preview", "P13", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10""")
def q_preview(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return P.preview(o, 10, ["o_orderkey"])


@query("run_id", "P14", sql="""
SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') AS run_id FROM events""")
def q_run_id(spark, sf):
    return P.run_id(t(spark, sf, "events"), "ts").select("event_id", "run_id")


# ---------------------------------------------------------------------------
# M: missing data
# ---------------------------------------------------------------------------
@query("fill_constant", "M1", sql="""
SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0.0), 0.0) AS l_discount,
       nullif(l_returnflag, 'R') AS l_returnflag
FROM lineitem""")
def q_fill_constant(spark, sf):
    li = M.fill_constant(_lineitem_nulls(spark, sf), 0)
    return li.select("l_orderkey", "l_linenumber", "l_discount", "l_returnflag")


@query("fill_constant_strings", "M1", sql="""
SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END, 'missing') AS o_orderpriority,
       coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END, 0.0) AS o_totalprice
FROM orders""")
def q_fill_constant_strings(spark, sf):
    o = t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"))
    # a string value fills string columns only; numbers take the numeric fill
    return M.fill_constant(M.fill_constant(o, "missing"), 0)


@query("fill_mean", "M2", sql="""
WITH m AS (SELECT avg(nullif(l_discount, 0.0)) AS mu FROM lineitem)
SELECT l_orderkey, l_linenumber, round(coalesce(nullif(l_discount, 0.0), m.mu), 6) AS l_discount
FROM lineitem CROSS JOIN m""")
def q_fill_mean(spark, sf):
    li = M.fill_mean(_lineitem_nulls(spark, sf), ["l_discount"])
    return li.select("l_orderkey", "l_linenumber", r("l_discount").alias("l_discount"))


@query("imputer_train_test", "M3,R1", sql=f"""
WITH li AS (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS d, nullif(l_tax, 0.0) AS x,
                   {B_L} < {TEST_CUT} AS is_test FROM lineitem),
m AS (SELECT avg(d) AS md, avg(x) AS mx FROM li WHERE NOT is_test)
SELECT l_orderkey, l_linenumber, round(coalesce(d, md), 6) AS l_discount, round(coalesce(x, mx), 6) AS l_tax
FROM li CROSS JOIN m WHERE is_test""")
def q_imputer(spark, sf):
    li = t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("nullif(l_discount, 0.0)").alias("l_discount"),
        F.expr("nullif(l_tax, 0.0)").alias("l_tax"))
    train, test = R.train_test_split(li, "l_orderkey", TEST_FRAC, SEED)
    params = M.fit_imputer(train, ["l_discount", "l_tax"])
    out = M.apply_imputer(test, params)
    return out.select("l_orderkey", "l_linenumber", r("l_discount").alias("l_discount"),
                      r("l_tax").alias("l_tax"))


@query("null_counts", "M4", sql="""
SELECT c AS "column", n AS nulls FROM (
  SELECT count(*) - count(l_orderkey) AS l_orderkey, count(*) - count(nullif(l_discount, 0.0)) AS l_discount,
         count(*) - count(nullif(l_returnflag, 'R')) AS l_returnflag, count(*) - count(l_shipdate) AS l_shipdate
  FROM lineitem) UNPIVOT (n FOR c IN (l_orderkey, l_discount, l_returnflag, l_shipdate))""")
def q_null_counts(spark, sf):
    li = _lineitem_nulls(spark, sf)
    return M.null_counts(li, ["l_orderkey", "l_discount", "l_returnflag", "l_shipdate"])


@query("complete_predictions", "M5,J1", sql="""
WITH p AS (SELECT l_orderkey AS o_orderkey, avg(l_extendedprice) AS pred FROM lineitem
           WHERE l_returnflag = 'R' GROUP BY l_orderkey),
m AS (SELECT avg(pred) AS mu FROM p)
SELECT o.o_orderkey, round(coalesce(p.pred, m.mu), 6) AS pred
FROM orders o LEFT JOIN p ON o.o_orderkey = p.o_orderkey CROSS JOIN m""")
def q_complete_predictions(spark, sf):
    preds = (t(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
             .groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.avg("l_extendedprice").alias("pred")))
    out = M.complete_predictions(t(spark, sf, "orders"), preds, "o_orderkey", "pred")
    return out.select("o_orderkey", r("pred").alias("pred"))


@query("table_info", "M6", sql="""
WITH c AS (SELECT count(*) AS rows, count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
                  count(o_orderstatus) AS o_orderstatus, count(o_totalprice) AS o_totalprice,
                  count(o_orderdate) AS o_orderdate, count(o_orderpriority) AS o_orderpriority FROM orders),
u AS (SELECT rows, col, non_null FROM c UNPIVOT (non_null FOR col IN
      (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)))
SELECT CAST(i.ordinal_position AS INTEGER) AS position, u.col AS "column",
       CASE i.data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
            ELSE lower(i.data_type) END AS type,
       u.non_null, u.rows
FROM u JOIN information_schema.columns i ON i.table_name = 'orders' AND i.column_name = u.col""")
def q_table_info(spark, sf):
    return M.table_info(t(spark, sf, "orders"))


# ---------------------------------------------------------------------------
# N: scaling
# ---------------------------------------------------------------------------
@query("minmax", "N1", sql="""
WITH s AS (SELECT min(c_acctbal) AS a0, max(c_acctbal) AS a1,
                  min(c_nationkey) AS n0, max(c_nationkey) AS n1 FROM customer)
SELECT c_custkey, round((c_acctbal - a0) / (a1 - a0), 6) AS c_acctbal,
       round((c_nationkey - n0) / (n1 - n0), 6) AS c_nationkey
FROM customer CROSS JOIN s""")
def q_minmax(spark, sf):
    c = t(spark, sf, "customer")
    out = N.apply_minmax(c, N.fit_minmax(c, ["c_acctbal", "c_nationkey"]))
    return out.select("c_custkey", r("c_acctbal").alias("c_acctbal"), r("c_nationkey").alias("c_nationkey"))


@query("standard_scale", "N2,R1", sql=f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
                   {B_L} < {TEST_CUT} AS is_test FROM lineitem),
s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
             avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM li WHERE NOT is_test)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity,
       round((l_extendedprice - mp) / sp, 6) AS l_extendedprice
FROM li CROSS JOIN s WHERE is_test""")
def q_standard_scale(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    train, test = R.train_test_split(li, "l_orderkey", TEST_FRAC, SEED)
    out = N.apply_standard(test, N.fit_standard(train, ["l_quantity", "l_extendedprice"]))
    return out.select("l_orderkey", "l_linenumber", r("l_quantity").alias("l_quantity"),
                      r("l_extendedprice").alias("l_extendedprice"))


@query("normalizer", "N3", sql="""
WITH s AS (SELECT avg(o_totalprice) AS m, greatest(stddev_pop(o_totalprice), 1e-7) AS sd FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / sd, 6) AS o_totalprice FROM orders CROSS JOIN s""")
def q_normalizer(spark, sf):
    o = t(spark, sf, "orders")
    out = N.apply_normalizer(o, N.fit_normalizer(o, ["o_totalprice"]))
    return out.select("o_orderkey", r("o_totalprice").alias("o_totalprice"))


# ---------------------------------------------------------------------------
# R: splits
# ---------------------------------------------------------------------------
@query("train_test_split", "R1", sql=f"""
SELECT o_orderkey, CASE WHEN {B_O} < {TEST_CUT} THEN 'test' ELSE 'train' END AS split FROM orders""")
def q_train_test_split(spark, sf):
    return R.assign_split(t(spark, sf, "orders"), "o_orderkey", TEST_FRAC, SEED).select("o_orderkey", "split")


@query("tail_split", "R2", sql="""
SELECT event_id, value FROM (
  SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS pos, count(*) OVER () AS n FROM events)
WHERE pos >= floor(n * 0.8)""")
def q_tail_split(spark, sf):
    _, val = R.tail_split(t(spark, sf, "events"), "event_id", 0.2)
    return val.select("event_id", "value")


@query("k_fold", "R3", sql=f"""
SELECT o_orderkey, CAST({B_O} % 5 AS INTEGER) AS fold FROM orders""")
def q_k_fold(spark, sf):
    return R.k_fold(t(spark, sf, "orders"), "o_orderkey", 5, SEED).select("o_orderkey", "fold")


@query("repeated_splits", "R4", sql="""
SELECT c_custkey, CAST(s AS INTEGER) AS seed,
       ('0x' || substr(md5(cast(c_custkey AS VARCHAR) || '-' || cast(s AS VARCHAR)), 1, 8))::BIGINT
         < 1073741824 AS is_test
FROM customer CROSS JOIN range(0, 5) r(s)""")
def q_repeated_splits(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey")
    return R.repeated_splits(c, "c_custkey", 5, TEST_FRAC)


@query("class_weights", "R6", sql="""
WITH s AS (SELECT count(*) FILTER (WHERE quality = 0) AS neg, count(*) FILTER (WHERE quality = 1) AS pos
           FROM labels)
SELECT doc_id, quality, round(CASE WHEN quality = 1 THEN neg / pos ELSE 1.0 END, 6) AS weight
FROM labels CROSS JOIN s""")
def q_class_weights(spark, sf):
    out = R.class_weights(t(spark, sf, "labels"), "quality")
    return out.select("doc_id", "quality", r("weight").alias("weight"))
