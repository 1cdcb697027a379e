"""Plan shape: Python stays out of the relational, statistics and text
plans; filters and projections reach the Parquet scan; top-k is limited
before the shuffle; no cross products."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF01

PYTHON_FREE = ["cheap_items", "customers_on_day", "repeat_buyer_days", "days_customer_or_product",
               "revenue_in_month", "busy_days", "spend_per_customer", "most_popular_product",
               "sales_per_head", "stats_by_attribute", "keyword_correlation", "corr_by_attribute",
               "word_counts", "top_words", "dice_lists", "json_field"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_no_python_and_no_cross_product(spark, name):
    plan = _plan(entry.queries()[name](spark, SF01))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)


def test_date_filter_pushed_to_scan(spark):
    plan = _plan(entry.queries()["revenue_in_month"](spark, SF01))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "EqualTo(p_type,ECONOMY)" in plan


def test_column_pruning(spark):
    plan = _plan(entry.queries()["spend_per_customer"](spark, SF01))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_top_words_partial_limit(spark):
    plan = _plan(entry.queries()["top_words"](spark, SF01))
    assert "WindowGroupLimit" in plan


def test_similarity_and_knn_without_cross_product(spark):
    for name in ("dice_join", "knn_confusion"):
        plan = _plan(entry.queries()[name](spark, SF01))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
