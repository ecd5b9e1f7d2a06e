"""What the plans of the registered queries must and must not contain."""

import os
import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
CHECKED = entry.retail_sql.sql(entry.RULE_TAGS)
LAZY = sorted(name for name in set(CHECKED) - set(entry.MODEL_TAGS) - {"product_name_lookup"}
              if not name.endswith("_check"))

# The columns each tag may read, by table prefix.
READS = {
    "tag_gender": {"c_custkey"},
    "tag_job": {"c_custkey", "c_mktsegment"},
    "tag_blacklist": {"c_custkey", "c_acctbal"},
    "tag_age_range": {"c_custkey"},
    "tag_consume_cycle": {"o_custkey", "o_orderdate"},
    "tag_unit_price": {"o_custkey", "o_totalprice"},
    "tag_max_order": {"o_custkey", "o_totalprice"},
    "tag_pay_type": {"o_custkey", "o_orderpriority"},
    "tag_return_count": {"o_custkey", "o_orderstatus"},
    "tag_log_frequency": {"user_id", "ts"},
    "tag_log_time_slot": {"user_id", "ts"},
    "click_ratings": {"user_id", "event_type", "props"},
    "psm_scores": {"o_custkey", "o_orderkey", "o_totalprice", "l_orderkey",
                   "l_extendedprice", "l_discount"},
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_unchecked_products(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for word in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct"):
        assert word not in text, word
    # Rows are compared pairwise with bands only, which are literals broadcast.
    for line in re.findall(r"BroadcastNestedLoopJoin.*", text):
        assert "BuildRight" in line and "_start" in line


@pytest.mark.parametrize("name", ["profile_sql", "profile_left"])
def test_few_rules_are_expressions(spark, name):
    """No rule is joined, and none is broadcast."""
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "BroadcastNestedLoopJoin" not in text and "LocalTableScan" not in text


@pytest.mark.parametrize("name", sorted(READS))
def test_only_needed_columns_are_read(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = {field.split(":")[0] for schema in read for field in schema.split(",")}
    assert columns == READS[name]


def test_the_discount_filter_reaches_the_scan(spark):
    text = plan(entry.queries()["psm_scores"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_discount,0.1)" in text


def test_user_joins_reuse_the_partitioning_of_the_aggregates(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan(entry.queries()["order_metrics"](spark, FOLDER))
    finally:
        spark.conf.set(key, before)
    # Orders by user; codes by user and code, then by user; orders and coupons by
    # order for the coupon join. The join of the parts adds none.
    assert text.count("SortMergeJoin") == 2
    assert text.count("Exchange hashpartitioning(memberId") + text.count(
        "Exchange hashpartitioning(userId") == 3
