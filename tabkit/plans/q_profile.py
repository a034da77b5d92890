"""Registered queries: aggregations and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators import profile as A
from tabkit.plans.common import r, t
from tabkit.plans.registry import query

CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li_corr(spark, sf):
    return t(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", F.expr("nullif(l_discount, 0.0)").alias("l_discount"), "l_tax",
        "l_returnflag", "l_linenumber", "l_linestatus")


_CORR_SQL = """
WITH li AS (SELECT l_quantity, l_extendedprice, nullif(l_discount, 0.0) AS l_discount, l_tax FROM lineitem),
p AS (SELECT * FROM (VALUES ('l_quantity', 'l_extendedprice'), ('l_quantity', 'l_discount'),
                            ('l_quantity', 'l_tax'), ('l_extendedprice', 'l_discount'),
                            ('l_extendedprice', 'l_tax'), ('l_discount', 'l_tax')) v(a, b)),
c AS (SELECT corr(l_quantity, l_extendedprice) AS c0, corr(l_quantity, l_discount) AS c1,
             corr(l_quantity, l_tax) AS c2, corr(l_extendedprice, l_discount) AS c3,
             corr(l_extendedprice, l_tax) AS c4, corr(l_discount, l_tax) AS c5 FROM li),
u AS (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, c0 AS r FROM c UNION ALL
      SELECT 'l_quantity', 'l_discount', c1 FROM c UNION ALL SELECT 'l_quantity', 'l_tax', c2 FROM c UNION ALL
      SELECT 'l_extendedprice', 'l_discount', c3 FROM c UNION ALL SELECT 'l_extendedprice', 'l_tax', c4 FROM c
      UNION ALL SELECT 'l_discount', 'l_tax', c5 FROM c)
"""


@query("overview", "A1", sql="""
SELECT 'rows' AS item, count(*) AS value FROM labels
UNION ALL SELECT 'quality', CAST(sum(quality) AS BIGINT) FROM labels
UNION ALL SELECT 'toxic', CAST(sum(toxic) AS BIGINT) FROM labels""")
def q_overview(spark, sf):
    return A.overview(t(spark, sf, "labels"), ["quality", "toxic"])


@query("value_counts", "A2", sql="""
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def q_value_counts(spark, sf):
    return A.value_counts(t(spark, sf, "orders"), "o_orderpriority")


@query("value_counts_by_value", "A3", sql="""
SELECT p_size, count(*) AS count FROM part WHERE p_size IS NOT NULL GROUP BY 1""")
def q_value_counts_by_value(spark, sf):
    return A.value_counts(t(spark, sf, "part"), "p_size", by="value")


@query("value_share", "A4", sql="""
SELECT nullif(l_returnflag, 'R') AS l_returnflag, count(*) AS count,
       round(count(*) * 100.0 / (SELECT count(*) FROM lineitem), 4) AS pct
FROM lineitem WHERE nullif(l_returnflag, 'R') IS NOT NULL GROUP BY 1""")
def q_value_share(spark, sf):
    li = t(spark, sf, "lineitem").select(F.expr("nullif(l_returnflag, 'R')").alias("l_returnflag"))
    return A.value_share(li, "l_returnflag")


@query("flag_rates", "A5", sql="""
SELECT 'quality' AS "column", round(avg(quality) * 100, 4) AS pct FROM labels
UNION ALL SELECT 'toxic', round(avg(toxic) * 100, 4) FROM labels""")
def q_flag_rates(spark, sf):
    return A.flag_rates(t(spark, sf, "labels"), ["quality", "toxic"])


@query("flag_rates_all_rows", "A5", sql="""
WITH d AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(o_orderstatus = 'F' AS INTEGER) END AS f,
                  CAST(o_orderpriority = '5-LOW' AS INTEGER) AS low FROM orders)
SELECT 'f' AS "column", round(sum(f) * 100.0 / count(*), 4) AS pct FROM d
UNION ALL SELECT 'low', round(sum(low) * 100.0 / count(*), 4) FROM d""")
def q_flag_rates_all_rows(spark, sf):
    o = t(spark, sf, "orders")
    d = o.select(F.when(F.col("o_orderpriority") != "1-URGENT", (F.col("o_orderstatus") == "F").cast("int"))
                  .alias("f"), (F.col("o_orderpriority") == "5-LOW").cast("int").alias("low"))
    # the "share of all rows" rule: nulls stay in the denominator
    return A.flag_rates(d, ["f", "low"], rule="rows")


@query("combo_counts_lists", "A9", sql="""
WITH w AS (SELECT string_split(p_type, ' ') AS combo FROM part),
c AS (SELECT combo, count(*) AS count FROM w GROUP BY combo)
SELECT array_to_string(combo, '|') AS combo, count, round(count * 100.0 / (SELECT count(*) FROM w), 4) AS pct
FROM c ORDER BY count DESC, combo LIMIT 10""")
def q_combo_counts_lists(spark, sf):
    p = t(spark, sf, "part").select(F.split("p_type", " ").alias("words"))
    top = A.combo_counts(p, "words", 10)
    return top.select(F.array_join("combo", "|").alias("combo"), "count", "pct")


@query("describe", "A6", bench=True, sql="""
WITH s AS (
  SELECT 'c_acctbal' AS "column", count(c_acctbal)::DOUBLE AS "count", avg(c_acctbal) AS mean,
         stddev_samp(c_acctbal) AS std, min(c_acctbal)::DOUBLE AS "min",
         quantile_cont(c_acctbal, 0.25) AS "25%", quantile_cont(c_acctbal, 0.5) AS "50%",
         quantile_cont(c_acctbal, 0.75) AS "75%", max(c_acctbal)::DOUBLE AS "max" FROM customer
  UNION ALL
  SELECT 'c_nationkey', count(c_nationkey)::DOUBLE, avg(c_nationkey), stddev_samp(c_nationkey),
         min(c_nationkey)::DOUBLE, quantile_cont(c_nationkey, 0.25), quantile_cont(c_nationkey, 0.5),
         quantile_cont(c_nationkey, 0.75), max(c_nationkey)::DOUBLE FROM customer)
SELECT "column", stat, round(value, 6) AS value
FROM s UNPIVOT (value FOR stat IN ("count", mean, std, "min", "25%", "50%", "75%", "max"))""")
def q_describe(spark, sf):
    d = A.describe(t(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])
    return d.select("column", "stat", r("value").alias("value"))


@query("skewness", "A7", sql="""
SELECT 'c_acctbal' AS "column", round(skewness(c_acctbal), 6) AS skewness FROM customer
UNION ALL SELECT 'c_nationkey', round(skewness(c_nationkey), 6) FROM customer""")
def q_skewness(spark, sf):
    s = A.skewness(t(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])
    return s.select("column", r("skewness").alias("skewness"))


@query("token_counts", "A8,E8", bench=True, sql=r"""
SELECT regexp_replace(tok, '^\s+|\s+$', '', 'g') AS token, count(*) AS count
FROM (SELECT unnest(string_split(text, ',')) AS tok FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def q_token_counts(spark, sf):
    return A.token_counts(t(spark, sf, "documents").select("text"), "text", ",")


@query("combo_counts", "A9", sql="""
WITH seq AS (SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS combo FROM conversations GROUP BY conv_id),
c AS (SELECT combo, count(*) AS count FROM seq GROUP BY combo)
SELECT combo, count, round(count * 100.0 / (SELECT count(*) FROM seq), 4) AS pct
FROM c ORDER BY count DESC, combo LIMIT 10""")
def q_combo_counts(spark, sf):
    top = A.sequence_counts(t(spark, sf, "conversations"), "conv_id", "turn", "role", 10)
    return top.select(F.array_join("combo", ",").alias("combo"), "count", "pct")


@query("distinct_values", "A10", sql="""
SELECT DISTINCT unnest(string_split(p_name, ' ')) AS value FROM part""")
def q_distinct_values(spark, sf):
    p = t(spark, sf, "part").select(F.split("p_name", " ").alias("words"))
    return A.distinct_values(p, "words", explode=True)


@query("correlation_matrix", "A11", bench=True, sql=_CORR_SQL + """
SELECT a, b, round(r, 6) AS r FROM u UNION ALL SELECT b, a, round(r, 6) FROM u
UNION ALL SELECT x, x, 1.0 FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) v(x)""")
def q_correlation_matrix(spark, sf):
    return A.correlation_matrix(_li_corr(spark, sf), CORR_COLS, decimals=6)


@query("strong_correlations", "A12", sql=_CORR_SQL + """
SELECT a, b, round(r, 6) AS r FROM u WHERE abs(r) > 0.3""")
def q_strong_correlations(spark, sf):
    s = A.strong_correlations(_li_corr(spark, sf), CORR_COLS, 0.3)
    return s.select("a", "b", r("r").alias("r"))


@query("target_correlation", "A13", sql="""
WITH li AS (SELECT l_quantity, l_extendedprice, nullif(l_discount, 0.0) AS l_discount, l_tax FROM lineitem)
SELECT 'l_quantity' AS "column", round(corr(l_quantity, l_extendedprice), 6) AS r FROM li
UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 6) FROM li
UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 6) FROM li
UNION ALL SELECT 'l_returnflag', 0.0""")
def q_target_correlation(spark, sf):
    tc = A.target_correlation(_li_corr(spark, sf), ["l_quantity", "l_discount", "l_tax", "l_returnflag"],
                              "l_extendedprice")
    return tc.select("column", r("r").alias("r"))


@query("histogram", "A14", sql="""
WITH s AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - mn) / ((mx - mn) / 10)), 9) AS INTEGER) AS bin, count(*) AS cnt
      FROM orders CROSS JOIN s WHERE o_totalprice IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(0, 10) r(i))
SELECT g.bin, round(mn + g.bin * (mx - mn) / 10, 4) AS lo, round(mn + (g.bin + 1) * (mx - mn) / 10, 4) AS hi,
       coalesce(b.cnt, 0) AS count
FROM g CROSS JOIN s LEFT JOIN b ON g.bin = b.bin""")
def q_histogram(spark, sf):
    h = A.histogram(t(spark, sf, "orders"), "o_totalprice", 10)
    return h.select("bin", r("lo", 4).alias("lo"), r("hi", 4).alias("hi"), "count")


@query("density", "A15", sql="""
WITH s AS (SELECT min(c_acctbal) AS mn, max(c_acctbal) AS mx, count(c_acctbal) AS n,
                  stddev_samp(c_acctbal) * pow(count(c_acctbal), -0.2) AS h FROM customer),
g AS (SELECT CAST(i AS INTEGER) AS i, mn + i * (mx - mn) / 199 AS x, n, h FROM s CROSS JOIN range(0, 200) r(i))
SELECT g.i, round(g.x, 4) AS x,
       round(sum(exp(-0.5 * pow((g.x - c.c_acctbal) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())), 9) AS density
FROM g CROSS JOIN customer c WHERE c.c_acctbal IS NOT NULL GROUP BY g.i, g.x, g.n, g.h""")
def q_density(spark, sf):
    d = A.density(t(spark, sf, "customer"), "c_acctbal", 200, "exact")
    return d.select(F.col("i").cast("int").alias("i"), r("x", 4).alias("x"), r("density", 9).alias("density"))


@query("box_stats", "A16", sql="""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events)
SELECT 'value' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr,
       round(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM events CROSS JOIN q WHERE value IS NOT NULL GROUP BY q1, median, q3""")
def q_box_stats(spark, sf):
    b = A.box_stats(t(spark, sf, "events"), ["value"])
    return b.select("column", *[r(c).alias(c) for c in ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]],
                    "n_outliers")


@query("outliers", "A16", sql="""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events CROSS JOIN q
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def q_outliers(spark, sf):
    return A.outliers(t(spark, sf, "events").select("event_id", "value"), "value")


@query("profile_report", "A17,A1,A4,A5,A6,A12", bench=True, sql=_CORR_SQL.replace(
    "FROM lineitem)", "FROM lineitem)", 1) + """,
base AS (SELECT l_quantity, l_linenumber, nullif(l_returnflag, 'R') AS l_returnflag,
                CAST(l_returnflag = 'R' AS INTEGER) AS is_returned,
                CAST(l_linestatus = 'O' AS INTEGER) AS is_open FROM lineitem),
ov AS (SELECT 'overview' AS section, 'rows' AS item, 'value' AS metric, count(*)::DOUBLE AS value FROM base
       UNION ALL SELECT 'overview', 'is_returned', 'value', sum(is_returned)::DOUBLE FROM base
       UNION ALL SELECT 'overview', 'is_open', 'value', sum(is_open)::DOUBLE FROM base),
ordn AS (
  SELECT 'l_quantity' AS item, count(l_quantity)::DOUBLE AS "count", avg(l_quantity) AS mean,
         stddev_samp(l_quantity) AS std, min(l_quantity)::DOUBLE AS "min", quantile_cont(l_quantity, 0.25) AS "25%",
         quantile_cont(l_quantity, 0.5) AS "50%", quantile_cont(l_quantity, 0.75) AS "75%",
         max(l_quantity)::DOUBLE AS "max" FROM base
  UNION ALL
  SELECT 'l_linenumber', count(l_linenumber)::DOUBLE, avg(l_linenumber), stddev_samp(l_linenumber),
         min(l_linenumber)::DOUBLE, quantile_cont(l_linenumber, 0.25), quantile_cont(l_linenumber, 0.5),
         quantile_cont(l_linenumber, 0.75), max(l_linenumber)::DOUBLE FROM base),
od AS (SELECT 'ordinal' AS section, item, metric, value FROM ordn
       UNPIVOT (value FOR metric IN ("count", mean, std, "min", "25%", "50%", "75%", "max"))),
fl AS (SELECT 'flags' AS section, 'is_returned' AS item, 'pct' AS metric, round(avg(is_returned) * 100, 4) AS value
       FROM base UNION ALL SELECT 'flags', 'is_open', 'pct', round(avg(is_open) * 100, 4) FROM base),
sh AS (SELECT 'shares' AS section, l_returnflag AS item, 'pct' AS metric,
              round(count(*) * 100.0 / (SELECT count(*) FROM base), 4) AS value
       FROM base WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag),
sp AS (SELECT 'strong_pairs' AS section, a || ' & ' || b AS item, 'r' AS metric, r AS value FROM u
       WHERE abs(r) > 0.3)
SELECT section, item, metric, round(value, 6) AS value
FROM (SELECT * FROM ov UNION ALL SELECT * FROM od UNION ALL SELECT * FROM fl
      UNION ALL SELECT * FROM sh UNION ALL SELECT * FROM sp)""")
def q_profile_report(spark, sf):
    li = t(spark, sf, "lineitem").select(
        "l_quantity", "l_linenumber", "l_extendedprice", F.expr("nullif(l_discount, 0.0)").alias("l_discount"),
        "l_tax", F.expr("nullif(l_returnflag, 'R')").alias("l_returnflag"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_returned"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_open"))
    rep = A.profile_report(li, ordinal=["l_quantity", "l_linenumber"], flags=["is_returned", "is_open"],
                           share_col="l_returnflag", corr_cols=CORR_COLS)
    return rep.select("section", "item", "metric", r("value").alias("value"))


@query("prediction_summary", "A18,M4", sql="""
SELECT count(*) AS rows, count(*) - count(value) AS nulls, round(avg(value), 6) AS mean FROM events""")
def q_prediction_summary(spark, sf):
    s = A.prediction_summary(t(spark, sf, "events"), "value")
    return s.select("rows", "nulls", r("mean").alias("mean"))
