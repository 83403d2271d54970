"""Physical plans: pushed filters, pruned columns, saved shuffles."""

import re

import pytest

from salesops.plans import selections
from salesops.sources import sales


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_month_filter_reaches_the_scan(spark, sf):
    plan = plan_of(selections.expected_deliveries(spark, sf))
    pushed = re.search(r"PushedFilters: \[([^\]]*l_shipdate[^\]]*)", plan).group(1)
    assert "GreaterThanOrEqual(l_shipdate" in pushed


def test_columns_are_pruned(spark, sf):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(sales.order_sums(spark, sf)))
    assert schemas == ["l_orderkey:bigint,l_quantity:double,l_extendedprice:double"]


def test_small_merge_does_not_shuffle_the_target(spark, sf):
    from pyspark.sql import functions as F

    from salesops.operators.dml import upsert
    from salesops.sources.tables import load

    delta = load(spark, sf, "customer").limit(3).select("c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    plan = plan_of(upsert(load(spark, sf, "customer"), delta, ["c_name"], {"c_acctbal": F.col("c_acctbal")}))
    kept = plan.split("Union")[1]
    assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in plan


def test_bucketed_tables_join_without_a_shuffle(spark, sf, tmp_path, no_broadcast):
    from salesops.plans.monthly import monthly_price_and_sales
    from salesops.sources.tables import SCHEMAS, store_bucketed
    from tests.conftest import rows

    catalog = store_bucketed(spark, sf, "bucketed", str(tmp_path), 4)
    try:
        df = monthly_price_and_sales(spark, catalog)
        assert rows(df) == rows(monthly_price_and_sales(spark, sf))
        plan = plan_of(df)
        assert "order_id" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
        assert plan.split("== Initial Plan ==")[1].count("Exchange hashpartitioning") == 1  # the months
    finally:
        for name in SCHEMAS:
            spark.sql(f"DROP TABLE bucketed.{name}")
        spark.sql("DROP SCHEMA bucketed")
