"""Registered queries: encoding and nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators import encode as E
from tabkit.operators import split as R
from tabkit.plans.common import SEED, TEST_CUT, TEST_FRAC, sql_bucket, t
from tabkit.plans.registry import query

B_O = sql_bucket("o_orderkey")
B_E = sql_bucket("event_id")

# An explicit low -> high level list ('1-URGENT' deliberately left out,
# so it encodes to null like an unknown label).
PRIORITY_LEVELS = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]


@query("encode_ordered", "E1", sql="""
SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1
                             WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 END AS INTEGER) AS o_orderpriority
FROM orders""")
def q_encode_ordered(spark, sf):
    o = E.encode_ordered(t(spark, sf, "orders"), {"o_orderpriority": PRIORITY_LEVELS})
    return o.select("o_orderkey", "o_orderpriority")


@query("ordinal_fit_apply", "E2,R1", sql=f"""
WITH lv AS (SELECT DISTINCT event_type FROM events WHERE {B_E} >= {TEST_CUT} AND event_type IS NOT NULL),
code AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS c FROM lv)
SELECT e.event_id, code.c AS event_type FROM events e LEFT JOIN code ON e.event_type = code.event_type""")
def q_ordinal(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type")
    train, _ = R.train_test_split(ev, "event_id", TEST_FRAC, SEED)
    return E.apply_ordinal(ev, E.fit_ordinal(train, ["event_type"]))


@query("one_hot", "E3", sql="""
SELECT l_orderkey, l_linenumber,
       CAST(coalesce(nullif(l_returnflag, 'R') = 'A', false) AS INTEGER) AS l_returnflag_A,
       CAST(coalesce(nullif(l_returnflag, 'R') = 'N', false) AS INTEGER) AS l_returnflag_N
FROM lineitem""")
def q_one_hot(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                         F.expr("nullif(l_returnflag, 'R')").alias("l_returnflag"))
    return E.one_hot(li, ["l_returnflag"])


@query("one_hot_named", "E4,A4,P10", sql="""
WITH n AS (SELECT count(*) AS total FROM customer)
SELECT 'segment_' || translate(lower(c_mktsegment), ' /', '__') AS "column",
       upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2) AS label,
       count(*) AS count, round(count(*) * 100.0 / any_value(n.total), 4) AS pct
FROM customer CROSS JOIN n WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""")
def q_one_hot_named(spark, sf):
    _, report = E.one_hot_named(t(spark, sf, "customer"), "c_mktsegment", prefix="segment")
    return report


@query("multi_hot", "E5,A10", sql="""
SELECT 'word_' || translate(lower(w), ' /', '__') AS "column", count(DISTINCT p_partkey) AS ones
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1""")
def q_multi_hot(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    params = E.fit_multi_hot(p, "words", prefix="word")
    enc = E.apply_multi_hot(p, "words", params)
    names = list(params.names)
    wide = enc.agg(*[F.sum(n).cast("bigint").alias(n) for n in names])
    return wide.unpivot([], names, "column", "ones")


_LITERAL = ("CASE WHEN lang = 'de' THEN 'nope' "
            "ELSE concat('[''', lang, ''', ''', source, ''']') END")


@query("parse_list", "E6", sql="""
SELECT doc_id, CAST(CASE WHEN lang = 'de' THEN 0 ELSE 2 END AS INTEGER) AS n_items,
       CASE WHEN lang = 'de' THEN '' ELSE lang || '|' || source END AS items
FROM documents""")
def q_parse_list(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.expr(_LITERAL).alias("lit"))
    d = E.parse_list(d, "lit", "items")
    return d.select("doc_id", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items"))


@query("flatten_lists", "E7", sql="""
SELECT conv_id, turn, CASE WHEN len(string_split(text, chr(10))) > 0
                            THEN array_to_string(string_split(text, chr(10)), ', ') END AS lines
FROM conversations""")
def q_flatten_lists(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", F.split("text", "\n").alias("lines"))
    return E.flatten_lists(c, ["lines"])


@query("explode_tokens", "E8", sql=r"""
SELECT doc_id, count(*) AS n_tokens, CAST(sum(length(regexp_replace(tok, '^\s+|\s+$', '', 'g'))) AS BIGINT) AS token_chars
FROM (SELECT doc_id, unnest(string_split(text, ',')) AS tok FROM documents) GROUP BY doc_id""")
def q_explode_tokens(spark, sf):
    d = E.explode_tokens(t(spark, sf, "documents").select("doc_id", "text"), "text", ",")
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                   F.sum(F.length("token")).cast("bigint").alias("token_chars"))


@query("one_hot_fitted", "E9,R1", sql=f"""
SELECT o_orderkey, CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) AS o_orderstatus_F,
       CAST(coalesce(o_orderstatus = 'O', false) AS INTEGER) AS o_orderstatus_O
FROM orders WHERE {B_O} < {TEST_CUT}""")
def q_one_hot_fitted(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    train, test = R.train_test_split(o, "o_orderkey", TEST_FRAC, SEED)
    # fitted where status 'P' is absent, so 'P' is unseen at apply time
    params = E.fit_one_hot(train.where(F.col("o_orderstatus").isin("F", "O")), ["o_orderstatus"])
    return E.apply_one_hot(test, params)


@query("align_columns", "E10,E3", sql=f"""
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F,
       CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, 0 AS o_orderstatus_X
FROM orders WHERE {B_O} < {TEST_CUT}""")
def q_align_columns(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    _, test = R.train_test_split(o, "o_orderkey", TEST_FRAC, SEED)
    enc = E.one_hot(test, ["o_orderstatus"])  # has F, O and P
    train_cols = ["o_orderkey", "o_orderstatus_F", "o_orderstatus_O", "o_orderstatus_X"]
    return E.align_columns(enc, train_cols)


@query("ordinal_table", "E2", sql="""
SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderkey::VARCHAR) - 1 AS key_code,
       dense_rank() OVER (ORDER BY o_orderdate) - 1 AS date_code FROM orders""")
def q_ordinal_table(spark, sf):
    """Codes of as many levels as rows, and of dates."""
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("k"), "o_orderdate")
    d = E.apply_ordinal_table(o, "k", E.fit_ordinal_table(o, "k"), "key_code")
    d = E.apply_ordinal_table(d, "o_orderdate", E.fit_ordinal_table(o, "o_orderdate"), "date_code")
    return d.select("o_orderkey", "key_code", "date_code")
