"""Null keys, NaN, odd literals, quoting and crashes: nothing is lost or
silently changed."""

import csv
import datetime as dt
import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.functions.scalar import label_from_name
from tabkit.operators import encode as E
from tabkit.operators import metrics as K
from tabkit.operators import missing as M
from tabkit.operators import models as L
from tabkit.operators import profile as A
from tabkit.operators import similar as V
from tabkit.operators import split as R
from tabkit.sources import ingest as I
from tabkit.sources import io as S


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame([(i if i % 3 else None, i) for i in range(15)], "id long, x int")


def test_splits_keep_rows_without_key(keyed):
    train, test = R.train_test_split(keyed, "id", 0.4, 1)
    assert train.count() + test.count() == 15 and test.where("id is null").count() == 0
    sides = {r.x: r.split for r in R.assign_split(keyed, "id", 0.4, 1).collect()}
    assert {r.x for r in train.collect()} == {x for x, s in sides.items() if s == "train"}
    folds = R.k_fold(keyed, "id", 4, 1)
    assert folds.where("fold is null").count() == 0
    assert sum(folds.where(f"fold = {f}").count() for f in range(4)) == 15
    assert R.repeated_splits(keyed, "id", 3).where("is_test is null").count() == 0


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_tail_split_on_times(spark, kind):
    rows = [(None if i % 5 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=30 * i), i) for i in range(40)]
    df = spark.createDataFrame(rows, "t timestamp, i int").withColumn("t", F.col("t").cast(kind))
    train, val = R.tail_split(df, "t", 0.25)
    assert train.count() + val.count() == 40 and train.where("t is null").count() == 8
    assert {r.i for r in val.collect()} == {i for i in range(40) if i % 5} - {r.i for r in train.collect()}
    assert val.count() == 8 and val.agg(F.min("i")).first()[0] > train.where("t is not null").agg(F.max("i")).first()[0]


def test_null_weight_is_an_error(spark):
    df = spark.createDataFrame([(1, 1.5), (2, None)], "id long, w double")
    with pytest.raises(Exception, match="null weight"):
        L.replicate_by_weight(df, "w", "id").collect()


@pytest.mark.parametrize("n", [256, 257])
def test_ordinal_has_one_schema(spark, n):
    df = spark.range(n).select(F.format_string("v%05d", "id").alias("g"), "id")
    out = E.apply_ordinal(df, E.fit_ordinal(df, ["g"]))
    assert out.columns == ["g", "id"] and out.where("g = id").count() == n
    added = E.apply_ordinal(df, E.fit_ordinal(df, ["g"]), "_code")
    assert added.columns == ["g", "id", "g_code"]


def test_one_hot_clash_is_an_error(spark):
    df = spark.createDataFrame([("b_c", "c")], "a string, a_b string")
    with pytest.raises(ValueError, match="clash"):
        E.one_hot(df, ["a", "a_b"])


def test_literals_and_labels(spark):
    rows = ["['a', None]", "('x', 'y')", "('x',)", "['None, b', \"it's\"]", "[", None, "[]", "['a',]"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    got = {r.i: r.s for r in E.parse_list(df, "s").collect()}
    assert got == {0: ["a", None], 1: ["x", "y"], 2: ["x"], 3: ["None, b", "it's"], 4: [], 5: [], 6: [], 7: ["a"]}
    piped = spark.createDataFrame([("a | b|c",)], "s string")
    assert [r.token for r in E.explode_tokens(piped, "s", "|").collect()] == ["a", "b", "c"]
    names = spark.createDataFrame([("p.x_sun-part",), ("p.x_o'neil",), ("pqx_3rd",)], "s string")
    assert [r[0] for r in names.select(label_from_name("s", "p.x_")).collect()] == ["Sun-Part", "O'Neil", "Pqx 3Rd"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (3.0, None)], "x double, n int")
    assert {r.column: r.nulls for r in M.null_counts(df).collect()} == {"x": 2, "n": 1}
    assert [r.x for r in M.fill_constant(df, 0).collect()] == [1.0, 0.0, 0.0, 3.0]
    assert [r.x for r in M.fill_mean(df, ["x"]).collect()] == [1.0, 2.0, 2.0, 3.0]
    assert [r.x for r in M.fill_mean(df, ["x"], only_if_nulls=True).collect()] == [1.0, 2.0, 2.0, 3.0]
    assert [r.x for r in M.apply_imputer(df, M.fit_imputer(df, ["x"])).collect()] == [1.0, 2.0, 2.0, 3.0]
    assert [r.x for r in M.nan_to_null(df).collect()] == [1.0, None, None, 3.0]


def test_null_probability_has_no_loss(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, None)], "y double, p double")
    assert K.log_loss(df, "y", "p").first()[0] == pytest.approx(np.log(2))


@pytest.mark.parametrize("method", ["exact", "binned"])
def test_density_of_a_constant_column(spark, method):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    assert A.density(df, "x", 10, method).count() == 0


def test_near_points_far_from_the_origin(spark):
    train = spark.createDataFrame([(i, [1e5 + 0.001 * i, 2e5, 3e5], float(i)) for i in range(100)], "id long, v array<double>, y double")
    query = spark.createDataFrame([(1000, [1e5 + 0.0472, 2e5, 3e5])], "id long, v array<double>")
    assert V.knn_regress(train, query, "id", "v", "y", 5).first().prediction == pytest.approx(47)


# -- files ------------------------------------------------------------------
def test_csv_quotes_and_header_order(spark, tmp_path):
    text = 'id,Name,x\n1,"Wirz, ""Mr."" Albert",2.5\n2,"a ""b""",NA\n'
    (tmp_path / "a.csv").write_text(text)
    df = S.read_table(spark, str(tmp_path / "a.csv"), "id int, Name string, x double")
    want = [(1, 'Wirz, "Mr." Albert', 2.5), (2, 'a "b"', None)]
    assert [tuple(r) for r in df.collect()] == want
    S.write_table(df, f"{tmp_path}/out")
    with open(glob.glob(f"{tmp_path}/out/*.csv")[0], newline="") as f:
        assert [row[1] for row in csv.reader(f)] == ["Name", 'Wirz, "Mr." Albert', 'a "b"']
    assert [tuple(r) for r in S.read_table(spark, f"{tmp_path}/out", "id int, Name string, x double").collect()] == want
    # the schema's order is not the header's
    assert [tuple(r) for r in S.read_table(spark, str(tmp_path / "a.csv"), "x double, id int").collect()] == [(2.5, 1), (None, 2)]
    with pytest.raises(ValueError, match="no column"):
        S.read_table(spark, str(tmp_path / "a.csv"), "id int, z int")


def test_rewrite_survives_a_crash(spark, tmp_path):
    base = str(tmp_path / "t")
    S.rewrite_table(spark.range(3), base)
    # a step that died before its pointer
    (tmp_path / "t" / "v=000002").mkdir()
    (tmp_path / "t" / "v=000002" / "part-0.parquet").write_text("half")
    assert S.read_current(spark, base).count() == 3
    S.rewrite_table(S.read_current(spark, base).where("id > 0"), base)
    assert S.read_current(spark, base).count() == 2 and S.current_version(spark, base).endswith("v=000002")


def test_append_keeps_rows_without_key(spark, tmp_path):
    target = str(tmp_path / "t")
    new = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "c")], "id long, v string")
    for expected in (1, 0, 0):
        assert I.append_new(spark, new, target, "id") == expected
    assert spark.read.parquet(target).count() == 1
    assert sorted(r.v for r in spark.read.parquet(f"{target}-without-key").collect()) == ["b", "c"]


def test_append_to_a_broken_target_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        I.append_new(spark, spark.createDataFrame([(1, "a")], "id long, v string"), str(tmp_path / "t"), "id")
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_stream_keeps_rows_without_key(spark, tmp_path):
    from tabkit.streaming.ingest import ingest_stream, read_ingested
    landing = tmp_path / "in"
    landing.mkdir()
    target = str(tmp_path / "t")
    for k, lines in enumerate(['{"id": 1, "v": "a"}\n{"v": "b"}\n{"id": 1, "v": "a"}', '{"id": 1, "v": "z"}\n{"id": 2, "v": "c"}\n{"v": "d"}']):
        (landing / f"{k}.json").write_text(lines)
        ingest_stream(spark, str(landing), "id long, v string", target, str(tmp_path / "c"), "id").awaitTermination()
    assert sorted(r.v for r in read_ingested(spark, target).collect()) == ["a", "c"]
    assert sorted(r.v for r in read_ingested(spark, f"{target}-without-key").collect()) == ["b", "d"]


def test_rate_limit_key(spark):
    rows = [(1, '{"data": [{"id": 1}], "X-RateLimit-Exceeded": true}'), (2, '{"X-RateLimit-Exceeded": "x", "message": "sorry"}'),
            (3, '{"data": [{"id": 3}]}'), (4, '{"message": "no"}'), (5, "?")]
    items, stats, errors = I.explode_pages(spark.createDataFrame(rows, "page int, body string"), "page", "body", "id int")
    assert [r.page for r in items.collect()] == [3] and [r.page for r in stats.collect()] == [3]
    assert {r.page: r.kind for r in errors.collect()} == {1: "rate_limited", 2: "rate_limited", 4: "error", 5: "unparseable"}
