"""Edge cases on inline rows (nulls, constant columns, unseen levels, ties,
empty input, duplicates)."""

import math

import pytest

from tabkit.operators import columns as P
from tabkit.operators import encode as E
from tabkit.operators import metrics as K
from tabkit.operators import missing as M
from tabkit.operators import profile as A
from tabkit.operators import scale as N
from tabkit.operators import similar as V
from tabkit.operators import split as R


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()] if cols else df.collect()


def test_encode_ordered_unknown_and_null(spark):
    df = spark.createDataFrame([(1, "Low"), (2, "High"), (3, "Slow"), (4, None)], "id int, g string")
    out = E.encode_ordered(df, {"g": ["Low", "Moderate", "High"]})
    assert rows(out, "id", "g") == [(1, 0), (2, 2), (3, None), (4, None)]


def test_ordinal_fit_apply_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "g string")
    test = spark.createDataFrame([(1, "c"), (2, "z"), (3, None)], "id int, g string")
    params = E.fit_ordinal(train, ["g"])
    assert params.levels["g"] == ["a", "b", "c"]
    assert rows(E.apply_ordinal(test, params), "id", "g") == [(1, 2), (2, None), (3, None)]


def test_one_hot_null_and_unseen_all_zero(spark):
    train = spark.createDataFrame([(1, "x"), (2, "y")], "id int, g string")
    test = spark.createDataFrame([(3, "y"), (4, "z"), (5, None)], "id int, g string")
    params = E.fit_one_hot(train, ["g"])
    out = E.apply_one_hot(test, params)
    assert out.columns == ["id", "g_x", "g_y"]
    assert rows(out, "id", "g_x", "g_y") == [(3, 0, 1), (4, 0, 0), (5, 0, 0)]


def test_align_columns_missing_and_extra(spark):
    df = spark.createDataFrame([(1, 1, 0)], "id int, g_a int, g_new int")
    out = E.align_columns(df, ["id", "g_a", "g_b"])
    assert out.columns == ["id", "g_a", "g_b"]
    assert rows(out) == [(1, 1, 0)]


def test_parse_list_cases(spark):
    df = spark.createDataFrame([(1, "['full sun', 'part shade']"), (2, "[]"), (3, "nope"), (4, None)],
                               "id int, s string")
    out = {r.id: r.s for r in E.parse_list(df, "s").collect()}
    assert out == {1: ["full sun", "part shade"], 2: [], 3: [], 4: []}


def test_multi_hot_collision_is_or(spark):
    df = spark.createDataFrame([(1, ["Full Sun"]), (2, ["full sun", "shade"]), (3, [])],
                               "id int, s array<string>")
    out = E.multi_hot(df, "s", "sun")
    assert [c for c in out.columns if c.startswith("sun_")] == ["sun_full_sun", "sun_shade"]
    assert rows(out, "id", "sun_full_sun", "sun_shade") == [(1, 1, 0), (2, 1, 1), (3, 0, 0)]


def test_flatten_lists_empty_is_null(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id int, l array<string>")
    assert rows(E.flatten_lists(df), "id", "l") == [(1, "a, b"), (2, None)]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(1, -5.0), (2, None), (3, 50.0)], "id int, x double")
    assert rows(P.clip(df, {"x": (0.0, 10.0)}), "id", "x") == [(1, 0.0), (2, None), (3, 10.0)]


def test_minmax_and_standard_constant_column(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "id int, x double")
    assert rows(N.apply_minmax(df, N.fit_minmax(df, ["x"])), "id", "x") == [(1, 0.0), (2, 0.0)]
    assert rows(N.apply_standard(df, N.fit_standard(df, ["x"])), "id", "x") == [(1, 0.0), (2, 0.0)]


def test_standard_uses_population_std(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    p = N.fit_standard(df, ["x"])
    assert p.means["x"] == 2.0 and p.scales["x"] == 1.0


def test_imputer_all_null_column_errors(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    with pytest.raises(ValueError, match="x"):
        M.fit_imputer(df, ["x"])


def test_fill_mean_stays_null_when_all_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    assert rows(M.fill_mean(df, ["x"]), "id", "x") == [(1, None), (2, None)]


def test_fill_constant_skips_strings_by_default(spark):
    df = spark.createDataFrame([(None, None)], "x double, s string")
    r = M.fill_constant(df, 0).first()
    assert r.x == 0.0 and r.s is None


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 2.0), (3.0, 5.0, 2.5)], "a double, c double, b double")
    m = {(r.a, r.b): r.r for r in A.correlation_matrix(df, ["a", "c", "b"]).collect()}
    assert m[("a", "c")] is None and m[("a", "a")] == 1.0
    assert m[("a", "b")] == pytest.approx(0.9819805, rel=1e-6)
    t = {r.column: r.r for r in A.target_correlation(df, ["c", "b"], "a").collect()}
    assert t["c"] is None


def test_skewness_small_n_is_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert A.skewness(df, ["x"]).first().skewness is None


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "x double")
    h = {r.bin: r["count"] for r in A.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 0, 3: 0, 4: 1}


def test_exact_quantiles_interpolate(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    q = {r.prob: r.value for r in A.exact_quantiles(df, ["x"], (0.25, 0.5, 0.75), n_buckets=2).collect()}
    assert q == {0.25: 1.75, 0.5: 2.5, 0.75: 3.25}


def test_roc_ties_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    pts = [(r.threshold, r.fpr, r.tpr) for r in K.roc_curve(df, "y", "s").collect()]
    assert sorted(pts, key=lambda p: (p[1], p[2])) == [(None, 0.0, 0.0), (0.9, 0.5, 0.5), (0.5, 0.5, 1.0),
                                                       (0.1, 1.0, 1.0)]
    assert K.roc_auc(df, "y", "s").first().auc == pytest.approx(0.625)
    one = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, s double")
    assert K.roc_auc(one, "y", "s").first().auc is None


def test_precision_recall_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, s double")
    r = K.precision_recall(df, "y", "s").first()
    assert (r.precision, r.recall) == (0.0, 0.0)


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 0.0)], "y int, p double")
    assert K.log_loss(df, "y", "p").first().log_loss == pytest.approx(-math.log(1e-7))


def test_cosine_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 0.0], [2.0, 0.0])], "a array<double>, b array<double>")
    assert [r.score for r in V.cosine_scores(df, "a", "b").collect()] == [0.0, 1.0]


def test_top_k_neighbours_matches_brute_force(spark):
    import random
    rnd = random.Random(3)
    items = [(i, [rnd.choice([0.0, 1.0, 2.0]) for _ in range(3)]) for i in range(40)]
    df = spark.createDataFrame(items, "id long, v array<double>")
    got = V.top_k_neighbours(df, df.withColumnRenamed("id", "nb"), "id", "v", "nb", "v", k=5,
                             query_block=7, item_block=9)

    def cos(a, b):
        na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return 0.0 if na * nb == 0 else sum(x * y for x, y in zip(a, b)) / (na * nb)

    want = set()
    for qi, qv in items:
        scored = sorted(((-round(cos(qv, iv), 9), ii) for ii, iv in items))[:5]
        want |= {(qi, r + 1, ii) for r, (_, ii) in enumerate(scored)}
    assert {(r.id, r.rank, r.nb) for r in got.collect()} == want


def test_preference_defaults(spark):
    prefs = spark.createDataFrame([(1, None, "part_sun", None, None, 3, None)],
                                  "user_id int, indoor boolean, sunlight string, drought_tolerance boolean, "
                                  "care_level int, maintenance_level int, watering_frequency int")
    r = V.preference_vectors(prefs).first()
    assert [r[c] for c in V.RECOMMENDER_FEATURES] == [1, 0, 1, 0, 0, 1, 3, 1]


def test_attach_by_key_rejects_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        V.attach_by_key(left, right, "k").collect()


def test_top_k_ties_by_id(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 0.5)], "id int, s double")
    assert [r.id for r in V.top_k(df, "s", 2, "id").collect()] == [1, 3]


def test_split_is_deterministic_and_partition_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = R.assign_split(df, "k", 0.25, 7)
    b = R.assign_split(df.repartition(13), "k", 0.25, 7)
    assert rows(a, "k", "split") == rows(b, "k", "split")
    n_test = a.where("split = 'test'").count()
    assert 400 < n_test < 600
    folds = {r.fold for r in R.k_fold(df, "k", 5, 1).select("fold").distinct().collect()}
    assert folds == {0, 1, 2, 3, 4}


def test_tail_split_exact(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "t int")
    train, val = R.tail_split(df, "t", 0.2)
    assert [r.t for r in val.orderBy("t").collect()] == [8, 9]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    w = sorted(r.weight for r in R.class_weights(df, "y").collect())
    assert w == [1.0, 1.0, 1.0, 3.0]


def test_binary_columns(spark):
    df = spark.createDataFrame([(0, 1, None), (1, 2, 1)], "a int, b int, c int")
    assert {r.column: r.is_binary for r in P.binary_columns(df).collect()} == {"a": True, "b": False, "c": False}


def test_drop_columns_unknown_name_errors(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        P.drop_columns(df, ["zzz"])


def test_cast_flags_null_errors(spark):
    df = spark.createDataFrame([(True,), (None,)], "f boolean")
    with pytest.raises(Exception, match="null in column f"):
        P.cast_flags(df, ["f"]).collect()


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    b = A.box_stats(df, ["x"]).first()
    assert (b.q1, b.median, b.q3) == (3.0, 5.0, 7.0)
    assert (b.whisker_lo, b.whisker_hi, b.n_outliers) == (1.0, 8.0, 1)
    assert [r.x for r in A.outliers(df, "x").collect()] == [100.0]


def test_sequence_counts_order_matters(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "b"), (2, 1, "a"), (3, 0, "a"), (3, 1, "b")],
                               "g int, pos int, v string")
    out = {tuple(r.combo): r["count"] for r in A.sequence_counts(df, "g", "pos", "v").collect()}
    assert out == {("a", "b"): 2, ("b", "a"): 1}


def test_recommend_dedupe_equals_direct_scoring(spark):
    import random
    rnd = random.Random(5)
    prefs = spark.createDataFrame(
        [(u, rnd.choice([True, False, None]), rnd.choice(["full_sun", "part_sun", "full_shade", None]),
          rnd.choice([True, None]), rnd.choice([0, 1, 2, None]), rnd.choice([0, 2, None]), rnd.choice([1, None]))
         for u in range(60)],
        "user_id long, indoor boolean, sunlight string, drought_tolerance boolean, care_level int, "
        "maintenance_level int, watering_frequency int")
    items = spark.createDataFrame(
        [tuple([i] + [rnd.choice([0, 1]) for _ in range(5)] + [rnd.choice([0, 1, 2, 3]) for _ in range(3)])
         for i in range(25)],
        "item long, " + ", ".join(f"{c} int" for c in V.RECOMMENDER_FEATURES))
    got = {(r.user_id, r.rank, r.item) for r in V.recommend(prefs, items, "item", k=4).collect()}
    users = V.preference_vectors(prefs).select("user_id", V.as_vector(V.RECOMMENDER_FEATURES).alias("u"))
    its = items.select("item", V.as_vector(V.RECOMMENDER_FEATURES).alias("v"))
    direct = V.top_k_neighbours(users, its, "user_id", "u", "item", "v", k=4)
    assert got == {(r.user_id, r.rank, r.item) for r in direct.collect()}


def test_approx_quantiles_close_to_exact(spark):
    df = spark.range(5000).selectExpr("cast((id * 7919) % 1000 as double) as x")
    ex = {r.prob: r.value for r in A.quantiles(df, ["x"], method="exact").collect()}
    ap = {r.prob: r.value for r in A.quantiles(df, ["x"], method="approx").collect()}
    for p in ex:
        assert abs(ex[p] - ap[p]) <= 2.0


def test_prefix_sums_join_paths_agree(spark):
    from tabkit.functions.prefix import add_buckets, prefix_sums_long
    rows = [(g, k, 1 + (k * 7 + g) % 5) for g in range(3) for k in range(40)]
    df = spark.createDataFrame(rows, "g int, k int, w int")
    b, (bc,) = add_buckets(df, ["k"], n_buckets=4)
    a = prefix_sums_long(b, ["g"], "k", ["w"], bc)
    c = prefix_sums_long(b, ["g"], "k", ["w"], bc, broadcast_rows=0)
    want = {}
    for g, k, w in sorted(rows):
        want[(g, k)] = want.get((g, k - 1), 0) + w if k else w
    assert {(r.g, r.k): r.cum_w for r in a.collect()} == want
    assert {(r.g, r.k): r.cum_w for r in c.collect()} == want


def test_fill_mean_only_if_nulls_keeps_complete_columns(spark):
    df = spark.createDataFrame([(1, 2, 1.0), (2, 4, None)], "id int, a int, b double")
    out = M.fill_mean(df, ["a", "b"], only_if_nulls=True)
    assert dict(out.dtypes)["a"] == "int"
    assert rows(out, "id", "a", "b") == [(1, 2, 1.0), (2, 4, 1.0)]


def test_combo_counts_ties_by_list_order(spark):
    df = spark.createDataFrame([(["b"],), (["a", "c"],), (["a"],), (["a", "c"],), (["b"],), (["a"],)],
                               "l array<string>")
    top = [(list(r.combo), r["count"]) for r in A.combo_counts(df, "l", 2).collect()]
    assert top == [(["a"], 2), (["a", "c"], 2)]


def test_split_requires_seed(spark):
    df = spark.range(10)
    with pytest.raises(ValueError, match="seed"):
        R.train_test_split(df, "id", 0.25)
    with pytest.raises(ValueError, match="seed"):
        R.k_fold(df, "id", 5)
