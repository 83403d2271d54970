"""Pivot, unpivot and text-list reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.dates import date_text, month_start
from salesops.functions.texts import between_parentheses, concat_text
from salesops.operators.aggregates import ordered_text, ordered_text_parts
from salesops.operators.joins import lookup
from salesops.operators.reshape import long_cells, pivot_dynamic, pivot_sum, unpivot_columns
from salesops.sources import sales

# The market segments of the customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _monthly_orders(spark: SparkSession, sf_dir: str, by_name: bool = False) -> DataFrame:
    """Orders per customer and month, reduced before the customer's attributes are joined."""
    heads = sales.orders(spark, sf_dir)
    counts = heads.groupBy("customer_id", month_start("order_date").alias("month")).agg(F.count("order_id").alias("orders"))
    return counts


def _by_date(pivot: DataFrame, by_text: bool) -> DataFrame:
    """The months as text, sorted by their date; ``by_text`` sorts as written, by the text."""
    shown = pivot.select(date_text("month").alias("invoice_month"), "*")
    return shown.orderBy("invoice_month" if by_text else "month").drop("month")


def customer_month_pivot(spark: SparkSession, sf_dir: str, by_text: bool = False) -> DataFrame:
    """Orders per month (rows) and customer segment (columns), the segment read from the
    parentheses of the customer's display name."""
    names = sales.customers(spark, sf_dir)
    display = concat_text(F.col("customer_name"), F.lit(" ("), F.col("segment"), F.lit(")"))
    clients = names.select("customer_id", between_parentheses(display).alias("client"))
    cells = lookup(_monthly_orders(spark, sf_dir), clients, ["customer_id"])
    return _by_date(pivot_sum(cells, "month", "client", SEGMENTS, "orders"), by_text)


def customer_month_pivot_dynamic(spark: SparkSession, sf_dir: str, by_text: bool = False) -> DataFrame:
    """Orders per month and customer nation; the columns are read from the nations of the customers."""
    places = sales.customers(spark, sf_dir).select("customer_id", "nation_id")
    places = lookup(places, sales.nations(spark, sf_dir).select("nation_id", "nation_name"), ["nation_id"])
    cells = lookup(_monthly_orders(spark, sf_dir), places, ["customer_id"])
    return _by_date(pivot_dynamic(cells, "month", "nation_name", "orders", names=places), by_text)


def customer_month_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells for every single customer, in long form, where columns would be too many."""
    clients = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    cells = lookup(_monthly_orders(spark, sf_dir), clients, ["customer_id"])
    return long_cells(cells, "month", "customer_name", "orders").select(date_text("month").alias("invoice_month"), "customer_name", "orders")


def addresses_unpivot(spark: SparkSession, sf_dir: str, pattern: str = "Customer%") -> DataFrame:
    """The address lines of customers who ordered, in one column; an empty line gives no row."""
    buyers = sales.orders(spark, sf_dir).select("customer_id").distinct()
    people = sales.customers(spark, sf_dir).filter(F.col("customer_name").like(pattern)).join(buyers, "customer_id", "left_semi")
    places = lookup(people, sales.nations(spark, sf_dir), ["nation_id"])
    places = lookup(places, sales.regions(spark, sf_dir), ["region_id"])
    lines = places.select(
        "customer_name",
        F.when(F.col("balance") >= 0, F.concat(F.lit("Shop "), F.col("customer_id"))).alias("delivery_line_1"),
        F.col("segment").alias("delivery_line_2"),
        F.col("nation_name").alias("postal_line_1"),
        F.col("region_name").alias("postal_line_2"),
    ).distinct()
    cols = ["delivery_line_1", "delivery_line_2", "postal_line_1", "postal_line_2"]
    return unpivot_columns(lines, ["customer_name"], cols, "address_line").orderBy("customer_name", "address_line")


def codes_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their letter code and their number code in one text column."""
    rows = sales.items(spark, sf_dir).select("item_id", "item_name", "brand", "weight")
    return unpivot_columns(rows, ["item_id", "item_name"], ["brand", "weight"], "code").orderBy("item_id", "code")


def segment_list_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation, its customers' segments in order, in one text."""
    rows = lookup(sales.customers(spark, sf_dir).select("nation_id", "segment"), sales.nations(spark, sf_dir), ["nation_id"])
    return ordered_text(rows, ["nation_name"], "segment", ", ")


def customer_list_by_nation(spark: SparkSession, sf_dir: str, width: int = 20) -> DataFrame:
    """Per nation, all its customers' names in order, in texts of ``width`` names."""
    rows = lookup(sales.customers(spark, sf_dir).select("nation_id", "customer_name"), sales.nations(spark, sf_dir), ["nation_id"])
    return ordered_text_parts(rows, ["nation_name"], "customer_name", ", ", width)
