"""What the operators ask of Spark: no Python rows, no cross joins, filters at the scan."""

import pytest

import catalog

SF = "/root/testdata/sf0.001"

NATIVE = [n for n in catalog.QUERIES if n.startswith((
    "filter_rows_", "filter_cols_", "transform_", "aggregate_", "merge_", "training_set",
    "pivot", "unpivot", "transpose", "profile_", "map_ids", "rename", "screen"))
    and n != "filter_rows_max_correlation"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    for word in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, (name, word)


def test_cutoffs_reach_the_scan(spark):
    plan = plan_of(catalog.QUERIES["filter_rows_col_gt_quantile"](spark, SF))
    assert "GreaterThan(l_extendedprice,ScalarSubquery" in plan.replace(" ", "")
    plan = plan_of(catalog.QUERIES["filter_rows_col_gt"](spark, SF))
    assert "GreaterThan(l_extendedprice,80000" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(catalog.QUERIES["filter_rows_group_size_ge"](spark, SF))
    assert "event_type" not in plan and "props" not in plan


def test_every_query_has_a_schema(spark):
    assert len(catalog.QUERIES) > 150
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
