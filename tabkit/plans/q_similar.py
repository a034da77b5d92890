"""Registered queries: top-k, key joins, preference vectors and vector
similarity (T1, J1, J2, V1-V4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators import similar as V
from tabkit.plans.common import SEED, TEST_CUT, r, sql_bucket, t
from tabkit.plans.registry import query

# ---------------------------------------------------------------------------
# users (preferences derived from customer) and items (features from part)
# ---------------------------------------------------------------------------
_PREFS_SQL = """
  SELECT c_custkey AS user_id,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal > 5000 END AS indoor,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'full_sun' WHEN 'BUILDING' THEN 'part_sun'
                           WHEN 'FURNITURE' THEN 'full_shade' END AS sunlight,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal > 2500 END AS drought_tolerance,
         CASE WHEN c_nationkey < 20 THEN CAST(floor(c_nationkey / 5.0) AS INTEGER) END AS care_level,
         CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 3334.0) AS INTEGER) END AS maintenance_level,
         CAST(floor(c_nationkey / 9.0) AS INTEGER) AS watering_frequency
  FROM customer"""

_ITEMS_SQL = """
  SELECT p_partkey,
         CAST(p_size <= 30 AS INTEGER) AS indoor,
         CAST(p_type LIKE 'STANDARD%' OR p_type LIKE 'LARGE%' AS INTEGER) AS sunlight_full_sun,
         CAST(p_type LIKE 'PROMO%' OR p_type LIKE 'MEDIUM%' AS INTEGER) AS sunlight_part_sun_part_shade,
         CAST(p_type LIKE 'ECONOMY%' OR p_type LIKE 'SMALL%' AS INTEGER) AS sunlight_full_shade,
         CAST(p_retailprice >= 950 AS INTEGER) AS drought_tolerant,
         CAST(floor((p_size - 1) / 12.5) AS INTEGER) AS care_level_encoded,
         CAST(floor((p_retailprice - 900) / 33.34) AS INTEGER) AS maintenance_encoded,
         length(p_brand) - 7 AS watering_encoded
  FROM part"""


def _prefs(spark, sf):
    c = t(spark, sf, "customer")
    bal, nat, seg = F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.when(bal >= 0, bal > 5000).alias("indoor"),
        F.when(seg == "AUTOMOBILE", "full_sun").when(seg == "BUILDING", "part_sun")
         .when(seg == "FURNITURE", "full_shade").alias("sunlight"),
        F.when(seg != "MACHINERY", bal > 2500).alias("drought_tolerance"),
        F.when(nat < 20, F.floor(nat / 5.0).cast("int")).alias("care_level"),
        F.when(bal >= 0, F.floor(bal / 3334.0).cast("int")).alias("maintenance_level"),
        F.floor(nat / 9.0).cast("int").alias("watering_frequency"))


def _items(spark, sf):
    p = t(spark, sf, "part")
    ty = F.col("p_type")
    return p.select(
        "p_partkey",
        (F.col("p_size") <= 30).cast("int").alias("indoor"),
        (ty.startswith("STANDARD") | ty.startswith("LARGE")).cast("int").alias("sunlight_full_sun"),
        (ty.startswith("PROMO") | ty.startswith("MEDIUM")).cast("int").alias("sunlight_part_sun_part_shade"),
        (ty.startswith("ECONOMY") | ty.startswith("SMALL")).cast("int").alias("sunlight_full_shade"),
        (F.col("p_retailprice") >= 950).cast("int").alias("drought_tolerant"),
        F.floor((F.col("p_size") - 1) / 12.5).cast("int").alias("care_level_encoded"),
        F.floor((F.col("p_retailprice") - 900) / 33.34).cast("int").alias("maintenance_encoded"),
        (F.length("p_brand") - 7).alias("watering_encoded"))


_VEC = "[{}]".format(", ".join(f"CAST({c} AS DOUBLE)" for c in V.RECOMMENDER_FEATURES))


def _cos_sql(a: str, b: str) -> str:
    return (f"CASE WHEN list_dot_product({a}, {a}) * list_dot_product({b}, {b}) > 0 "
            f"THEN list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))) "
            f"ELSE 0.0 END")


@query("top_k", "T1", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def q_top_k(spark, sf):
    return V.top_k(t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 25, "o_orderkey")


@query("attach_by_key", "J1", sql="""
SELECT o_orderkey, o_totalprice, c_mktsegment, c_acctbal
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_attach_by_key(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment", "c_acctbal")
    return V.attach_by_key(o, c, "custkey").drop("custkey")


@query("not_yet_seen", "J2", sql="""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def q_not_yet_seen(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    seen = (t(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
            .select(F.col("l_orderkey").alias("o_orderkey")))
    return V.not_yet_seen(o, seen, "o_orderkey")


@query("preference_vectors", "V1", sql=f"""
SELECT user_id,
       coalesce(CAST(indoor AS INTEGER), 1) AS indoor,
       CASE WHEN sunlight = 'full_sun' THEN 1 ELSE 0 END AS sunlight_full_sun,
       CASE WHEN sunlight = 'part_sun' THEN 1 ELSE 0 END AS sunlight_part_sun_part_shade,
       CASE WHEN sunlight = 'full_shade' THEN 1 ELSE 0 END AS sunlight_full_shade,
       coalesce(CAST(drought_tolerance AS INTEGER), 0) AS drought_tolerant,
       coalesce(care_level, 1) AS care_level_encoded,
       coalesce(maintenance_level, 1) AS maintenance_encoded,
       coalesce(watering_frequency, 1) AS watering_encoded
FROM ({_PREFS_SQL})""")
def q_preference_vectors(spark, sf):
    return V.preference_vectors(_prefs(spark, sf))


@query("cosine_to_centroid", "V2", sql=f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM e),
c AS (SELECT label, j, avg(x) AS m FROM x GROUP BY label, j),
cv AS (SELECT label, list(m ORDER BY j) AS cen FROM c GROUP BY label)
SELECT e.vec_id, e.label, round({_cos_sql('e.v', 'cv.cen')}, 6) AS score
FROM e JOIN cv ON e.label = cv.label""")
def q_cosine_to_centroid(spark, sf):
    e = t(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    # centroid per label: element-wise mean, one aggregate (partial per task)
    pos = e.select("label", F.posexplode("embedding").alias("j", "x"))
    cen = (pos.groupBy("label", "j").agg(F.avg(F.col("x").cast("double")).alias("m"))
           .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("j", "m"))).alias("cs"))
           .select("label", F.transform("cs", lambda s: s["m"]).alias("centroid")))
    pairs = e.join(cen, "label")
    return V.cosine_scores(pairs, "embedding", "centroid").select("vec_id", "label", r("score").alias("score"))


@query("recommend", "V3,V1,V2,T1", bench=True, sql=f"""
WITH u AS (SELECT user_id, {_VEC} AS uv FROM (
  SELECT user_id,
       coalesce(CAST(indoor AS INTEGER), 1) AS indoor,
       CASE WHEN sunlight = 'full_sun' THEN 1 ELSE 0 END AS sunlight_full_sun,
       CASE WHEN sunlight = 'part_sun' THEN 1 ELSE 0 END AS sunlight_part_sun_part_shade,
       CASE WHEN sunlight = 'full_shade' THEN 1 ELSE 0 END AS sunlight_full_shade,
       coalesce(CAST(drought_tolerance AS INTEGER), 0) AS drought_tolerant,
       coalesce(care_level, 1) AS care_level_encoded,
       coalesce(maintenance_level, 1) AS maintenance_encoded,
       coalesce(watering_frequency, 1) AS watering_encoded
  FROM ({_PREFS_SQL}))),
i AS (SELECT p_partkey, {_VEC} AS iv FROM ({_ITEMS_SQL})),
s AS (SELECT user_id, p_partkey, {_cos_sql('uv', 'iv')} AS score FROM u, i),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, p_partkey) AS rank FROM s)
SELECT user_id, CAST(rank AS INTEGER) AS rank, p_partkey, round(score, 6) AS score FROM k WHERE rank <= 10""")
def q_recommend(spark, sf):
    rec = V.recommend(_prefs(spark, sf), _items(spark, sf), "p_partkey", k=10)
    return rec.select("user_id", "rank", "p_partkey", r("score").alias("score"))


_NEAREST_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id, b.vec_id AS nb_id,
             list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS score
      FROM e a, e b WHERE a.vec_id <> b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, nb_id) AS rank FROM s)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, nb_id, round(score, 6) AS score FROM k WHERE rank <= 10"""


@query("nearest_neighbours", "V3,V2", bench=True, sql=_NEAREST_SQL)
def q_nearest_neighbours(spark, sf):
    e = t(spark, sf, "embeddings").select("vec_id", "embedding")
    nn = V.top_k_neighbours(e, e.select(F.col("vec_id").alias("nb_id"), "embedding"),
                            "vec_id", "embedding", "nb_id", "embedding", k=10, exclude_self=True)
    return nn.select("vec_id", "rank", "nb_id", r("score").alias("score"))


_KNN_SQL = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
                  {sql_bucket('vec_id')} < {TEST_CUT} AS is_test FROM embeddings),
s AS (SELECT q.vec_id, tr.vec_id AS tid, tr.label, list_distance(q.v, tr.v) AS d
      FROM e q, e tr WHERE q.is_test AND NOT tr.is_test),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(d, 9), tid) AS rank FROM s)
SELECT vec_id, round(avg(label), 6) AS prediction FROM k WHERE rank <= 20 GROUP BY vec_id"""


@query("knn_regress", "V4,R1", bench=True, sql=_KNN_SQL)
def q_knn_regress(spark, sf):
    from tabkit.operators.split import train_test_split
    e = t(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    train, test = train_test_split(e, "vec_id", 0.25, SEED)
    pred = V.knn_regress(train, test, "vec_id", "embedding", "label", k=20)
    return pred.select("vec_id", r("prediction").alias("prediction"))


@query("nearest_neighbours_pruned", "V3,V2", sql=_NEAREST_SQL)
def q_nearest_neighbours_pruned(spark, sf):
    """The same neighbours, partitions ruled out by pivots."""
    e = t(spark, sf, "embeddings").select("vec_id", "embedding")
    nn, _ = V.top_k_pruned(e, e.select(F.col("vec_id").alias("nb_id"), "embedding"),
                           "vec_id", "embedding", "nb_id", "embedding", k=10, exclude_self=True)
    return nn.select("vec_id", "rank", "nb_id", r("score").alias("score"))


@query("knn_regress_pruned", "V4,R1", sql=_KNN_SQL)
def q_knn_regress_pruned(spark, sf):
    from tabkit.operators.split import train_test_split
    e = t(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    train, test = train_test_split(e, "vec_id", 0.25, SEED)
    pred = V.knn_regress(train, test, "vec_id", "embedding", "label", k=20, prune=True)
    return pred.select("vec_id", r("prediction").alias("prediction"))
