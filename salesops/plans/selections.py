"""Selections, joins and subquery reports over the sales model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions import dates
from salesops.operators.joins import lookup, without_related, without_related_full
from salesops.operators.predicates import in_month, in_period, in_trimmed, keep_in, like_any, not_in
from salesops.operators.toplimit import deep_page, last_key, page, page_after, top_n, top_n_distinct, top_with_ties
from salesops.sources import sales
from salesops.sources.facts import in_months_of, store_by_month
from salesops.sources.storage import work_dir

LINE_KEY = ["line_no", "item_id", "supplier_id"]  # with the order id, the key of a line


def items_by_name_pattern(spark: SparkSession, sf_dir: str, patterns: tuple[str, ...] = ("%ring%", "red%"),
                          ignore_case: bool = False) -> DataFrame:
    """Items whose name matches one of the patterns."""
    found = sales.items(spark, sf_dir).filter(like_any("item_name", list(patterns), ignore_case))
    return found.select("item_id", "item_name")


def _orders_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.orders(spark, sf_dir).select("order_id", "customer_id")


def entities_without_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have no line."""
    return without_related(_orders_named(spark, sf_dir), sales.lines(spark, sf_dir), ["order_id"])


def entities_without_children_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a full outer join."""
    return without_related_full(_orders_named(spark, sf_dir), sales.lines(spark, sf_dir), ["order_id"])


def entities_without_children_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by NOT IN, with its NULL rules."""
    return not_in(_orders_named(spark, sf_dir), sales.lines(spark, sf_dir), "order_id").distinct()


def _price_or_quantity(spark: SparkSession, sf_dir: str, price: float, quantity: int, language: str) -> DataFrame:
    lines = sales.lines(spark, sf_dir).select("order_id", "line_no", "item_id", "supplier_id", "unit_cents", "quantity")
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id", "order_date", "picked")
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    dear = F.col("unit_cents") > int(price * 100)
    bulk_picked = (F.col("quantity") > quantity) & F.col("picked")
    # Most lines can be neither; they are left out before the shuffle.
    lines = lines.filter(dear | (F.col("quantity") > quantity))
    kept = lookup(lookup(lines, heads, ["order_id"]).filter(dear | bulk_picked), names, ["customer_id"])
    return kept.select(
        "order_id",
        "order_date",
        dates.date_text("order_date").alias("order_date_text"),
        dates.month_name("order_date", language).alias("month_name"),
        F.quarter("order_date").alias("quarter"),
        dates.third_of_year("order_date").alias("third"),
        "customer_name",
        *LINE_KEY,
    )


def _calendar_order(by_text: bool) -> list[Column]:
    day = "order_date_text" if by_text else "order_date"
    return [F.col(c) for c in ["quarter", "third", day, "order_id", *LINE_KEY]]


def orders_price_or_quantity(spark: SparkSession, sf_dir: str, price: float = 60000, quantity: int = 20,
                             language: str = "ru", by_text: bool = False) -> DataFrame:
    """Order lines dearer than ``price``, or of more than ``quantity`` pieces in a picked order.

    One row per line. Sorted by quarter, third and date; ``by_text`` sorts by the date as
    text (dd.MM.yyyy), which is not the order of time. The line's own key ends the sort,
    so that a range can be cut inside a day or an order with very many lines.
    """
    rows = _price_or_quantity(spark, sf_dir, price, quantity, language)
    return rows.orderBy(*_calendar_order(by_text)).drop("order_date", *LINE_KEY)


def orders_price_or_quantity_page(spark: SparkSession, sf_dir: str, start: int = 1000, width: int = 100, num: int = 1,
                                  price: float = 60000, quantity: int = 20, language: str = "ru") -> DataFrame:
    """One page of it: skip ``start`` rows and the pages before ``num``."""
    rows = _price_or_quantity(spark, sf_dir, price, quantity, language)
    return page(rows, _calendar_order(False), start, width, num).drop("order_date", *LINE_KEY)


def orders_price_or_quantity_deep_page(spark: SparkSession, sf_dir: str, start: int = 2000, width: int = 100, num: int = 1,
                                       price: float = 60000, quantity: int = 20, language: str = "ru") -> DataFrame:
    """A page so deep that the rows before it must not meet in one task."""
    rows = _price_or_quantity(spark, sf_dir, price, quantity, language)
    return deep_page(rows, _calendar_order(False), start, width, num).drop("order_date", *LINE_KEY)


def orders_page_walk(spark: SparkSession, sf_dir: str, width: int = 500, num: int = 3) -> DataFrame:
    """Page ``num`` of the orders, latest first, reached page by page from the last row seen; only that row's key comes to the driver."""
    order = {"order_ts": True, "order_id": False}
    rows = sales.orders(spark, sf_dir).select("order_id", "order_ts", "customer_id", "total_cents")
    seen = page_after(rows, order, width)
    for _ in range(num - 1):
        key = last_key(seen, order)
        if key is None:
            break
        seen = page_after(rows, order, width, key)
    return seen.select("order_id", F.to_date("order_ts").alias("order_date"), "customer_id", "total_cents")


def expected_deliveries(spark: SparkSession, sf_dir: str, year: int = 1997, month: int = 1,
                        methods: tuple[str, ...] = ("1-URGENT", "2-HIGH")) -> DataFrame:
    """Deliveries due in a month, of finished orders sent by one of the methods."""
    lines = in_month(sales.lines(spark, sf_dir), "ship_ts", year, month)
    due = lines.select("order_id", *LINE_KEY, "ship_date")
    heads = in_months_of(sales.orders(spark, sf_dir), lines, "order_ts").filter(in_trimmed("priority", list(methods)) & F.col("picked"))
    heads = heads.select("order_id", "customer_id", "priority")
    names = sales.suppliers(spark, sf_dir).select("supplier_id", "supplier_name")
    contacts = sales.customers(spark, sf_dir).select("customer_id", F.col("customer_name").alias("contact_name"))
    joined = lookup(lookup(due.join(heads, "order_id"), names, ["supplier_id"]), contacts, ["customer_id"])
    return joined.orderBy("supplier_name", "priority", "ship_date", "order_id", *LINE_KEY).select(
        "supplier_name", F.col("priority").alias("delivery_method"), F.col("ship_date").alias("delivery_date"), "contact_name"
    )


def expected_deliveries_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from facts stored by month: one shipping month of lines is read, and the months of their orders."""
    return expected_deliveries(spark, store_by_month(spark, sf_dir, work_dir(spark, "months")))


def last_sales_with_ties(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """The n last orders by date, and all others of the same last day, with customer and seller.

    The seller of an order is the lowest supplier id on its lines; only the lines of the
    chosen orders are read into the aggregate.
    """
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    last = top_with_ties(heads, {"order_date": True}, n)
    sold = keep_in(sales.lines(spark, sf_dir).select("order_id", "supplier_id"), last.select("order_id"), ["order_id"])
    sellers = sold.groupBy("order_id").agg(F.min("supplier_id").alias("supplier_id"))
    named = lookup(lookup(last, sales.customers(spark, sf_dir).select("customer_id", "customer_name"), ["customer_id"]),
                   sellers, ["order_id"])
    people = sales.suppliers(spark, sf_dir).select("supplier_id", F.col("supplier_name").alias("seller_name"))
    return lookup(named, people, ["supplier_id"]).select("order_id", "order_date", "customer_name", "seller_name").orderBy(
        F.col("order_date").desc(), "order_id"
    )


def buyers_of_item(spark: SparkSession, sf_dir: str, item_name: str = "red ring") -> DataFrame:
    """Customers who bought items of a name, one row per purchase line."""
    wanted = sales.items(spark, sf_dir).filter(F.col("item_name") == item_name).select("item_id")
    bought = keep_in(sales.lines(spark, sf_dir).select("order_id", *LINE_KEY), wanted, ["item_id"], unique=True)
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id")
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name", "segment")
    joined = lookup(heads.join(bought, "order_id"), names, ["customer_id"])
    return joined.orderBy("customer_name", "customer_id", "order_id", *LINE_KEY).select("customer_id", "customer_name", "segment")


def sellers_without_sale_on_day(spark: SparkSession, sf_dir: str, day: dt.date = dt.date(1998, 7, 4)) -> DataFrame:
    """Sales people without a sale on a day."""
    that_day = in_period(sales.orders(spark, sf_dir), "order_ts", day, day).select("order_id")
    sold = keep_in(sales.lines(spark, sf_dir).select("order_id", "supplier_id"), that_day, ["order_id"], unique=True)
    people = sales.suppliers(spark, sf_dir).select("supplier_id", "supplier_name")
    return without_related(people, sold, ["supplier_id"])


def cheapest_items(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """The n cheapest items, lowest id first among equals."""
    prices = sales.items(spark, sf_dir).select("item_id", "item_name", "price")
    return top_n(prices, [F.col("price"), F.col("item_id")], n)


def cheapest_items_in(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """The same rows chosen by id from an inner top-n."""
    prices = sales.items(spark, sf_dir).select("item_id", "item_name", "price")
    return keep_in(prices, cheapest_items(spark, sf_dir, n), ["item_id"], unique=True)


def items_at_minimal_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item that has the lowest price."""
    prices = sales.items(spark, sf_dir).select("item_id", "item_name", "price")
    return prices.filter(F.col("price") == prices.agg(F.min("price")).scalar())


def largest_payers(spark: SparkSession, sf_dir: str, n: int = 5, ascending: bool = False) -> DataFrame:
    """Customers of the n largest single payments (``ascending``: the n smallest of the customers' largest)."""
    paid = sales.orders(spark, sf_dir).groupBy("customer_id").agg(F.max("total_cents").alias("max_cents"))
    by = F.col("max_cents").asc() if ascending else F.col("max_cents").desc()
    top = top_n_distinct(paid, [by, F.col("customer_id")], n)
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name", "segment")
    return names.join(top, "customer_id").select(
        "segment", "customer_name", sales.money("max_cents").alias("max_amount")
    ).orderBy(F.col("max_amount").desc(), "customer_name")


def largest_payers_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest_payers(spark, sf_dir, ascending=True)


def cities_of_dearest_items(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """Where the n items with the highest unit price (in picked orders) went, and who packed those orders.

    Lines of picked orders are needed twice: for the price ranking and for the orders of
    the ranked items. The ranking is n rows, so the second use is a small semi join.
    """
    picked = sales.orders(spark, sf_dir).filter("picked").select("order_id", "customer_id")
    sold = sales.lines(spark, sf_dir).select("order_id", "item_id", "unit_cents", "supplier_id")
    in_picked = keep_in(sold, picked, ["order_id"], unique=True)
    dearest = top_n(in_picked.groupBy("item_id").agg(F.max("unit_cents").alias("top_cents")),
                    [F.col("top_cents").desc(), F.col("item_id")], n)
    chosen = keep_in(sold.select("order_id", "item_id"), dearest, ["item_id"], unique=True).select("order_id").distinct()
    packed = keep_in(picked, chosen, ["order_id"]).join(keep_in(sold, chosen, ["order_id"]), "order_id")
    packed = packed.select("customer_id", "supplier_id").distinct()
    places = sales.customers(spark, sf_dir).select("customer_id", "nation_id")
    packers = sales.suppliers(spark, sf_dir).select("supplier_id", F.col("supplier_name").alias("packer_name"))
    cities = sales.nations(spark, sf_dir).select("nation_id", F.col("nation_name").alias("city_name"))
    named = lookup(lookup(lookup(packed, places, ["customer_id"]), packers, ["supplier_id"]), cities, ["nation_id"])
    return named.select(F.col("nation_id").alias("city_id"), "city_name", "packer_name").distinct()


def large_invoices_with_picked_total(spark: SparkSession, sf_dir: str, minimum: float = 400000) -> DataFrame:
    """Invoices above a sum, with seller, and the sum of their lines if the order was picked (else NULL).

    One aggregate of the lines gives the total, the seller and the picked total; the large
    ones are filtered before anything is joined.
    """
    totals = (
        sales.lines(spark, sf_dir)
        .groupBy("order_id")
        .agg(F.sum("amount_cents").alias("sum_cents"), F.min("supplier_id").alias("supplier_id"))
        .filter(F.col("sum_cents") > int(minimum * 100))
    )
    heads = sales.orders(spark, sf_dir).select("order_id", "order_date", "picked")
    people = sales.suppliers(spark, sf_dir).select("supplier_id", F.col("supplier_name").alias("seller_name"))
    joined = lookup(heads.join(totals, "order_id"), people, ["supplier_id"])
    return joined.select(
        "order_id", "order_date", "seller_name",
        sales.money("sum_cents").alias("invoice_sum"),
        F.when(F.col("picked"), sales.money("sum_cents")).alias("picked_sum"),
    ).orderBy(F.col("invoice_sum").desc(), "order_id")
