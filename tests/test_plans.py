"""Plan-shape checks: pruning and pushdown reach the parquet scan, top-k is
a TakeOrdered, k-nearest-neighbour candidates are limited before the
shuffle, no plan pairs rows with a nested-loop join."""

import re

import pytest

from tabkit.plans.registry import all_queries

Q = all_queries()


def plan(spark, sf_dir, name):
    return Q[name].build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def read_schemas(p):
    return re.findall(r"ReadSchema: (struct<[^>]*>)", p)


def test_projection_prunes_columns(spark, sf_dir):
    p = plan(spark, sf_dir, "select_features")
    assert read_schemas(p) == ["struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>"]


def test_feature_slice_reads_only_used_columns(spark, sf_dir):
    schemas = read_schemas(plan(spark, sf_dir, "feature_slice"))
    assert "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double,l_returnflag:string>" in schemas
    assert "struct<o_orderkey:bigint,o_orderstatus:string>" in schemas


def test_filter_pushed_to_scan(spark, sf_dir):
    p = plan(spark, sf_dir, "not_yet_seen")
    assert "EqualTo(l_returnflag,R)" in p


def test_top_k_is_take_ordered(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, "top_k")


def test_knn_limits_candidates_before_shuffle(spark, sf_dir):
    p = plan(spark, sf_dir, "nearest_neighbours")
    assert "WindowGroupLimit" in p and "FlatMapCoGroupsInPandas" in p


def test_value_counts_partial_aggregate(spark, sf_dir):
    assert "partial_count" in plan(spark, sf_dir, "value_counts")


@pytest.mark.parametrize("name", ["feature_slice", "fill_mean", "histogram", "value_share", "roc_curve",
                                  "class_weights", "complete_predictions", "recommend", "outliers"])
def test_no_nested_loop_join(spark, sf_dir, name):
    assert "NestedLoopJoin" not in plan(spark, sf_dir, name)
