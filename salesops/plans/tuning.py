"""The cross-billing report in its original and in its tuned form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.dates import days_between
from salesops.operators.joins import match_counts
from salesops.operators.predicates import keep_in
from salesops.operators.skew import join_per_key
from salesops.operators.windows import with_group_total
from salesops.sources import sales
from salesops.sources.storage import materialize


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per order. It is billed to the first customer of the same nation and segment (the
    head office); a partly delivered order is invoiced a day later."""
    clients = sales.customers(spark, sf_dir).select("customer_id", "nation_id", "segment")
    offices = with_group_total(clients, ["nation_id", "segment"], [F.min("customer_id").alias("bill_to_id")])
    billing = offices.select("customer_id", "bill_to_id")
    late = F.when(F.col("status") == "P", 1).otherwise(0)
    heads = sales.orders(spark, sf_dir).select(
        "order_id", "customer_id", F.date_add("order_date", late).alias("invoice_date"))
    return heads.join(billing, "customer_id")


def tuned_cross_billing(spark: SparkSession, sf_dir: str, brand: str = "Brand#12", minimum: float = 2.0e6) -> DataFrame:
    """Per customer and item of one supplier: unit prices, pieces and lines, over invoices billed to someone
    else on the order's day, of customers above a total, each line counted once per stock movement of its item.

    The movements are a many-to-many partner that only multiplies. They are counted per item
    first and the sums are multiplied, so the pairs are never formed.
    """
    supplied = sales.items(spark, sf_dir).filter(F.col("brand") == brand).select("item_id")
    lines = sales.lines(spark, sf_dir).select("order_id", "item_id", "unit_cents", "quantity")
    chosen = keep_in(lines, supplied, ["item_id"], unique=True)
    moves = match_counts(chosen.select(F.col("item_id").alias("moved_item")), ["moved_item"])
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    bills = invoices(spark, sf_dir).withColumnsRenamed({"customer_id": "invoice_customer_id", "order_id": "invoice_order_id"})
    # The few lines of the supplier drive the joins; they are summed per order first.
    pieces = chosen.groupBy("order_id", "item_id").agg(
        F.sum("unit_cents").alias("unit_cents"), F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))
    billed = pieces.join(heads, "order_id").join(
        bills,
        (F.col("order_id") == F.col("invoice_order_id"))
        & (F.col("bill_to_id") != F.col("customer_id"))
        & (days_between("invoice_date", "order_date") == 0),
    )
    billed = materialize(billed)
    # Totals are made for the customers that are billed, not for all.
    payers = keep_in(heads, billed.select(F.col("invoice_customer_id").alias("customer_id")), ["customer_id"])
    totals = payers.join(sales.order_sums(spark, sf_dir), "order_id").groupBy("customer_id").agg(F.sum("sum_cents").alias("_total"))
    totals = totals.filter(F.col("_total") > int(minimum * 100)).select(F.col("customer_id").alias("invoice_customer_id"))
    billed = keep_in(billed, totals, ["invoice_customer_id"])
    # Each bill has one payment, which in this model is the bill's own order; the stored bills stand for it.
    sums = billed.groupBy("customer_id", "item_id").agg(
        F.sum("unit_cents").alias("unit_cents"), F.sum("quantity").alias("quantity"), F.sum("n").alias("n"))
    return join_per_key(sums, moves, [("item_id", "moved_item")], "inner").select(
        "customer_id", "item_id",
        sales.money(F.col("unit_cents") * F.col("matches")).alias("sum_unit_price"),
        (F.col("quantity") * F.col("matches")).alias("sum_quantity"),
        (F.col("n") * F.col("matches")).alias("order_count"),
    ).orderBy("customer_id", "item_id")


def cross_billing_original(spark: SparkSession, sf_dir: str, brand: str = "Brand#12", minimum: float = 2.0e6) -> DataFrame:
    """The same with correlated subqueries in WHERE, which Catalyst turns into joins."""
    return spark.sql(
        """
        WITH moves AS (SELECT item_id, count(*) AS n FROM {lines} GROUP BY item_id),
        billed AS (
        SELECT o.customer_id, l.item_id, sum(l.unit_cents) AS unit_cents, sum(l.quantity) AS quantity, count(*) AS n
        FROM {orders} o
        JOIN {lines} l ON l.order_id = o.order_id
        JOIN {invoices} i ON i.order_id = o.order_id
        JOIN {orders} t ON t.order_id = i.order_id
        WHERE i.bill_to_id != o.customer_id
          AND (SELECT max(brand) FROM {items} s WHERE s.item_id = l.item_id) = :brand
          AND (SELECT sum(x.amount_cents) FROM {lines} x JOIN {orders} y ON y.order_id = x.order_id
               WHERE y.customer_id = i.customer_id) > :minimum
          AND datediff(o.order_date, i.invoice_date) = 0
        GROUP BY o.customer_id, l.item_id)
        SELECT b.customer_id, b.item_id, b.unit_cents * m.n / 100 AS sum_unit_price,
               b.quantity * m.n AS sum_quantity, b.n * m.n AS order_count
        FROM billed b JOIN moves m ON m.item_id = b.item_id
        ORDER BY b.customer_id, b.item_id
        """,
        args={"brand": brand, "minimum": int(minimum * 100)},
        lines=sales.lines(spark, sf_dir), orders=sales.orders(spark, sf_dir), items=sales.items(spark, sf_dir), invoices=invoices(spark, sf_dir),
    )
