"""Parameterised reports: table functions, scalar functions and procedures."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.operators.joins import apply_rows
from salesops.operators.predicates import keep_in
from salesops.operators.toplimit import arg_max
from salesops.sources import sales


def invoice_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices that have lines, with customer, date and sum."""
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    return sales.order_sums(spark, sf_dir).select("order_id", "sum_cents").join(heads, "order_id")


def customer_with_max_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer of the largest invoice, with that invoice (lowest id among equals).

    The winner is found on the line sums alone, before any join.
    """
    best = arg_max(sales.order_sums(spark, sf_dir), "sum_cents", [F.col("order_id")])
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    return heads.join(best, "order_id").join(names, "customer_id").select(
        "customer_id", "customer_name", "order_id", "order_date", sales.money("sum_cents").alias("invoice_sum")
    )


def customer_id_with_max_invoice(spark: SparkSession, sf_dir: str) -> int | None:
    """Scalar form: the id only."""
    row = customer_with_max_invoice(spark, sf_dir).select("customer_id").first()
    return None if row is None else row[0]


def invoices_of_customer(spark: SparkSession, sf_dir: str, customer_id: int = -1) -> DataFrame:
    """Invoices and sums of one customer, latest first; an id of 0 or less means the customer with the largest invoice.

    The best customer is resolved to its id first, so that the scan of the orders is filtered by a value.
    Only the lines of the customer's invoices are summed.
    """
    wanted = customer_id if customer_id > 0 else customer_id_with_max_invoice(spark, sf_dir)
    heads = sales.orders(spark, sf_dir).select("customer_id", "order_id", "order_date")
    own = heads.filter(F.col("customer_id") == F.lit(wanted))
    found = keep_in(sales.lines(spark, sf_dir).select("order_id", "amount_cents"), own.select("order_id"), ["order_id"])
    sums = found.groupBy("order_id").agg(F.sum("amount_cents").alias("sum_cents"))
    return (
        own.join(sums, "order_id")
        .select("customer_id", "order_id", "order_date", sales.money("sum_cents").alias("invoice_sum"))
        .orderBy(F.col("order_date").desc(), "order_id")
    )


def invoices_of_customers(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None) -> DataFrame:
    """The invoices of every customer of a set, one NULL row where there are none (table function per row)."""
    outer = (customers if customers is not None else sales.customers(spark, sf_dir)).select("customer_id")
    sums = invoice_sums(spark, sf_dir).select(
        "customer_id", "order_id", "order_date", sales.money("sum_cents").alias("invoice_sum")
    )
    return apply_rows(outer, sums, ["customer_id"], keep_unmatched=True)


def register_functions(spark: SparkSession, sf_dir: str) -> str:
    """The same reports as SQL functions: ..._best_customer(), ..._best_customer_id(), ..._invoices_of(id).

    Returns the prefix of their names and of the views behind them; each folder of tables has its own.
    """
    own = "sales_" + hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    sales.orders(spark, sf_dir).createOrReplaceTempView(f"{own}_orders")
    sales.lines(spark, sf_dir).createOrReplaceTempView(f"{own}_lines")
    sales.customers(spark, sf_dir).createOrReplaceTempView(f"{own}_customers")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {own}_best_customer()
        RETURNS TABLE (customer_id BIGINT, customer_name STRING, order_id BIGINT, order_date DATE, invoice_sum DOUBLE)
        RETURN SELECT c.customer_id, c.customer_name, o.order_id, o.order_date, b.sum_cents / 100
               FROM (SELECT order_id, sum(amount_cents) AS sum_cents FROM {own}_lines
                     GROUP BY order_id ORDER BY sum_cents DESC, order_id LIMIT 1) b
               JOIN {own}_orders o ON o.order_id = b.order_id
               JOIN {own}_customers c ON c.customer_id = o.customer_id
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {own}_best_customer_id()
        RETURNS BIGINT
        RETURN SELECT max(customer_id) FROM {own}_best_customer()
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {own}_invoices_of(wanted BIGINT)
        RETURNS TABLE (customer_id BIGINT, order_id BIGINT, order_date DATE, invoice_sum DOUBLE)
        RETURN SELECT o.customer_id, o.order_id, o.order_date, s.sum_cents / 100
               FROM (SELECT order_id, sum(amount_cents) AS sum_cents FROM {own}_lines GROUP BY order_id) s
               JOIN {own}_orders o ON o.order_id = s.order_id
               WHERE o.customer_id = {own}_invoices_of.wanted
    """)
    return own


def invoices_by_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table function called once per customer row, in SQL."""
    own = register_functions(spark, sf_dir)
    return spark.sql(f"""
        SELECT c.customer_id, f.order_id, f.order_date, f.invoice_sum
        FROM {own}_customers c LEFT JOIN LATERAL {own}_invoices_of(c.customer_id) f
    """)


def best_customer_by_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar function used in a filter."""
    own = register_functions(spark, sf_dir)
    return spark.sql(f"""
        SELECT customer_id, customer_name FROM {own}_customers WHERE customer_id = {own}_best_customer_id()
    """)
