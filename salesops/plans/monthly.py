"""Monthly totals, thresholds, empty months, running totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.dates import month_end, month_start
from salesops.operators.aggregates import range_profile, weighted_mean, with_empty_months
from salesops.operators.joins import lookup
from salesops.operators.predicates import keep_in
from salesops.operators.windows import month_totals_window, running_total, running_total_lookup
from salesops.sources import sales
from salesops.sources.storage import materialize


def _sums_with_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per order with its date. Both sides meet on the order id they are already hashed by."""
    heads = sales.orders(spark, sf_dir).select("order_id", "order_date")
    return lookup(sales.order_sums(spark, sf_dir), heads, ["order_id"])


def monthly_price_and_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and mean price per month; the mean price is the amount over the pieces, not a mean of prices."""
    return (
        _sums_with_date(spark, sf_dir)
        .groupBy(F.year("order_date").alias("date_year"), F.month("order_date").alias("date_month"))
        .agg(
            sales.money(F.sum("sum_cents")).alias("month_sum"),
            weighted_mean(F.col("sum_cents"), F.col("sum_quantity") * 100).alias("month_mean_price"),
        )
        .orderBy("date_year", "date_month")
    )


def months_over_threshold(spark: SparkSession, sf_dir: str, minimum: float = 4.2e7) -> DataFrame:
    """Months with sales above a sum."""
    return (
        _sums_with_date(spark, sf_dir)
        .groupBy(F.year("order_date").alias("date_year"), F.month("order_date").alias("date_month"))
        .agg(F.sum("sum_cents").alias("_cents"))
        .filter(F.col("_cents") > int(minimum * 100))
        .select("date_year", "date_month", sales.money("_cents").alias("month_sum"))
        .orderBy("date_year", "date_month")
    )


def _item_month_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per item and month (first day), with first sale and pieces."""
    sold = sales.lines(spark, sf_dir).select("order_id", "item_id", "amount_cents", "quantity")
    heads = sales.orders(spark, sf_dir).select("order_id", "order_date")
    return (
        lookup(sold, heads, ["order_id"])
        .groupBy("item_id", month_start("order_date").alias("month"))
        .agg(
            F.sum("amount_cents").alias("sum_cents"),
            F.min("order_date").alias("first_sale"),
            F.sum("quantity").alias("quantity"),
        )
    )


def _name_month_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per item name: items are reduced before their names are joined."""
    names = sales.items(spark, sf_dir).select("item_id", "item_name")
    return (
        lookup(_item_month_sums(spark, sf_dir), names, ["item_id"])
        .groupBy("item_name", "month")
        .agg(
            F.sum("sum_cents").alias("sum_cents"),
            F.min("first_sale").alias("first_sale"),
            F.sum("quantity").alias("quantity"),
        )
    )


def slow_items_by_month(spark: SparkSession, sf_dir: str, below: int = 200) -> DataFrame:
    """Item names that sold fewer pieces than ``below`` in a month: sum, first sale, pieces."""
    return (
        _name_month_sums(spark, sf_dir)
        .filter(F.col("quantity") < below)
        .select(
            F.year("month").alias("date_year"), F.month("month").alias("date_month"), "item_name",
            sales.money("sum_cents").alias("month_sum"), "first_sale", F.col("quantity").alias("month_quantity"),
        )
        .orderBy("date_year", "date_month", "item_name")
    )


def months_zero_filled(spark: SparkSession, sf_dir: str, item_name: str = "red ring", brand: str = "Brand#7") -> DataFrame:
    """Monthly sales of one kind of item over the whole calendar of orders; a month without sales shows 0."""
    kind = sales.items(spark, sf_dir).filter((F.col("item_name") == item_name) & (F.col("brand") == brand))
    sold = keep_in(sales.lines(spark, sf_dir).select("order_id", "item_id", "amount_cents"), kind, ["item_id"], unique=True)
    heads = sales.orders(spark, sf_dir).select("order_id", "order_date")
    report = lookup(sold, heads, ["order_id"]).groupBy(month_start("order_date").alias("month")).agg(
        F.sum("amount_cents").alias("sum_cents"))
    calendar = heads.agg(F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))
    filled = with_empty_months(report, calendar, ["sum_cents"])
    return filled.select(
        F.year("month").alias("date_year"), F.month("month").alias("date_month"), sales.money("sum_cents").alias("month_sum")
    ).orderBy("date_year", "date_month")


def slow_items_zero_filled(spark: SparkSession, sf_dir: str, below: int = 10) -> DataFrame:
    """Items and months with fewer pieces than ``below``, months without any sale between
    the item's first and last one included with 0."""
    sold = materialize(_item_month_sums(spark, sf_dir))
    calendar = sold.groupBy("item_id").agg(F.min("month").alias("first_date"), F.max("month").alias("last_date"))
    filled = with_empty_months(sold.select("item_id", "month", "sum_cents", "quantity"), calendar,
                               ["sum_cents", "quantity"], ["item_id"])
    return filled.filter(F.col("quantity") < below).select(
        F.year("month").alias("date_year"), F.month("month").alias("date_month"), "item_id",
        sales.money("sum_cents").alias("month_sum"), F.col("quantity").alias("month_quantity"),
    )


def _since(spark: SparkSession, sf_dir: str, start: dt.date) -> DataFrame:
    """Orders with lines since a day: id, customer, date, month end, sum. Stored, as the report reads it twice."""
    heads = sales.orders(spark, sf_dir).filter(F.col("order_ts") >= F.lit(start)).select("order_id", "customer_id", "order_date")
    sums = sales.order_sums(spark, sf_dir).select("order_id", "sum_cents")
    return materialize(heads.join(sums, "order_id").withColumn("month", month_end("order_date")))


def _running_report(spark: SparkSession, sf_dir: str, orders: DataFrame, months: DataFrame) -> DataFrame:
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    running = F.broadcast(months.select("month", "running_cents"))  # bounded by the calendar
    joined = lookup(lookup(orders, running, ["month"]), names, ["customer_id"])
    return joined.select(
        "order_date", "customer_name", "order_id",
        sales.money("sum_cents").alias("order_sum"), sales.money("running_cents").alias("running_sum"),
    ).orderBy("order_date", "customer_name", "order_id")


def running_month_total_selfjoin(spark: SparkSession, sf_dir: str, start: dt.date = dt.date(1999, 1, 1)) -> DataFrame:
    """Orders since a day with the running total of their month, without a window."""
    orders = _since(spark, sf_dir, start)
    months = orders.groupBy("month").agg(F.sum("sum_cents").alias("month_cents"))
    return _running_report(spark, sf_dir, orders, running_total_lookup(months, "month", "month_cents", "running_cents"))


def running_month_total_window(spark: SparkSession, sf_dir: str, start: dt.date = dt.date(1999, 1, 1)) -> DataFrame:
    """The same with windows: monthly totals, then a running sum over them."""
    orders = _since(spark, sf_dir, start)
    months = month_totals_window(orders, F.col("month"), "sum_cents", "month_cents")
    return _running_report(spark, sf_dir, orders, running_total(months, "month", "month_cents", "running_cents"))


def running_month_totals(spark: SparkSession, sf_dir: str, start: dt.date = dt.date(1999, 1, 1)) -> DataFrame:
    """The running totals alone, one row per month."""
    months = month_totals_window(_since(spark, sf_dir, start), F.col("month"), "sum_cents", "month_cents")
    run = running_total(months, "month", "month_cents", "running_cents")
    return run.select("month", sales.money("month_cents").alias("month_sum"), sales.money("running_cents").alias("running_sum"))


def months_with_sales(spark: SparkSession, sf_dir: str, year: int = 1999) -> DataFrame:
    """Which months of a year have sales lines."""
    heads = sales.orders(spark, sf_dir).filter(
        F.col("order_ts").between(F.lit(dt.datetime(year, 1, 1)), F.lit(dt.datetime(year, 12, 31, 23, 59, 59, 999999)))
    ).select("order_id", "order_date")
    with_lines = keep_in(heads, sales.lines(spark, sf_dir), ["order_id"])
    return with_lines.select(F.month("order_date").alias("month_number")).distinct()


def customer_range_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last invoice date and number of invoices per customer."""
    return range_profile(sales.orders(spark, sf_dir), ["customer_id"], "order_date")


def order_and_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, picked orders and lines per status: count(*), count(column), and the highest id overall."""
    heads = sales.orders(spark, sf_dir)
    per_order = sales.lines(spark, sf_dir).groupBy("order_id").agg(F.count(F.lit(1)).alias("line_count"))
    joined = lookup(heads, per_order, ["order_id"])
    top = heads.agg(F.max("order_id")).scalar()
    return joined.groupBy("status").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count("line_count").alias("with_lines"),
        F.coalesce(F.sum("line_count"), F.lit(0)).alias("line_count"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    ).withColumn("max_order_id", top)
