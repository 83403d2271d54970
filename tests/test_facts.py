"""Facts stored by month: same reports, and only the months asked for are read."""

import re

from pyspark.sql import functions as F

from salesops.plans import finance, monthly, selections
from salesops.sources import sales
from salesops.sources.facts import in_months_of, store_by_month, with_month
from salesops.sources.tables import load
from tests.conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_are_the_same(spark, sf, tmp_path):
    stored = store_by_month(spark, sf, str(tmp_path))
    for report in (selections.expected_deliveries, finance.postings_in_period, monthly.monthly_price_and_sales, monthly.slow_items_by_month,
                   selections.sellers_without_sale_on_day, selections.orders_price_or_quantity):
        assert rows(report(spark, stored)) == rows(report(spark, sf)), report.__name__
    assert rows(load(spark, stored, "customer")) == rows(load(spark, sf, "customer"))


def test_partition_filters_and_dynamic_pruning(spark, sf, tmp_path):
    stored = store_by_month(spark, sf, str(tmp_path))
    assert "PartitionFilters: [isnotnull(o_orderdate_month" in plan_of(finance.postings_in_period(spark, stored))
    plan = plan_of(selections.expected_deliveries(spark, stored))
    assert "PartitionFilters: [isnotnull(l_shipdate_month" in plan
    assert "dynamicpruningexpression(o_orderdate_month" in plan


def test_other_months_are_not_read(spark, sf, tmp_path):
    stored = store_by_month(spark, sf, str(tmp_path))
    all_months = load(spark, stored, "orders").select("o_orderdate_month").distinct().count()
    lines = sales.lines(spark, stored).where("ship_ts_month = DATE'1997-01-01'").orderBy("order_id", "line_no").limit(4)
    df = in_months_of(sales.orders(spark, stored), lines, "order_ts").select("order_id", "order_ts_month")
    months = {r.order_ts_month for r in df.collect()}
    assert months == {r.order_ts_month for r in lines.collect()}
    assert 0 < len(months) < all_months / 4
    scan = re.search(r"dynamicpruningexpression\(o_orderdate_month", plan_of(df))
    assert scan


def test_null_dates_hot_months_and_lines_without_order(spark, tmp_path):
    base = tmp_path / "in"
    orders = spark.sql("SELECT id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, 1.0D AS o_totalprice, "
                       "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN make_timestamp_ntz(2020, 5, 1 + CAST(id % 28 AS INT), 0, 0, 0) "
                       "ELSE timestampadd(DAY, CAST(id AS INT), TIMESTAMP_NTZ'2019-01-01') END AS o_orderdate, 'x' AS o_orderpriority FROM range(600)")
    orders.write.parquet(f"{base}/orders.parquet")
    lines = orders.select((F.col("o_orderkey") + 300).alias("l_orderkey"), F.lit(1).cast("bigint").alias("l_partkey"), F.lit(1).cast("bigint").alias("l_suppkey"),
                          F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
                          F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.col("o_orderdate").alias("l_shipdate"))
    lines.write.parquet(f"{base}/lineitem.parquet")
    stored = store_by_month(spark, str(base), str(tmp_path / "out"))
    for name in ("orders", "lineitem"):
        back = load(spark, stored, name)
        assert rows(back.select(load(spark, str(base), name).columns)) == rows(load(spark, str(base), name))
    assert load(spark, stored, "orders").where("o_orderdate_month IS NULL").count() == 12
    assert load(spark, stored, "lineitem").where("o_orderdate_month IS NULL").count() == 306


def test_companion_month(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-02-29 23:59:59' AS d UNION ALL SELECT NULL")
    assert sorted(str(r.d_month) for r in with_month(df, "d").collect()) == ["2024-02-01", "None"]
