"""Window reports: tops, ranks, tiles, neighbours, group totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.texts import first_letter
from salesops.operators.joins import apply_rows, lookup, top_n_per_outer
from salesops.operators.ordered import Neighbour, dense_ranks, running_sum, tile, with_dense_rank, with_position
from salesops.operators.predicates import in_period, keep_in
from salesops.operators.predicates import keep_in
from salesops.operators.skew import join_per_key
from salesops.operators.windows import latest_rows, latest_values, top_n_per_group, with_group_total, within_top_values
from salesops.sources import sales
from salesops.sources.storage import materialize


def top2_items_by_month(spark: SparkSession, sf_dir: str, year: int = 1999, n: int = 2) -> DataFrame:
    """The n best sold items (by pieces) of each month of a year."""
    heads = in_period(sales.orders(spark, sf_dir), "order_ts", dt.date(year, 1, 1), dt.date(year, 12, 31))
    heads = heads.select("order_id", F.month("order_date").alias("month_number"))
    sold = sales.lines(spark, sf_dir).select("order_id", "item_id", "quantity").join(heads, "order_id")
    pieces = sold.groupBy("item_id", "month_number").agg(F.sum("quantity").alias("pieces"))
    best = top_n_per_group(pieces, ["month_number"], [F.col("pieces").desc(), F.col("item_id")], n)
    named = lookup(best, sales.items(spark, sf_dir).select("item_id", "item_name"), ["item_id"])
    return named.select("item_id", "item_name", "month_number", "pieces", "place").orderBy("month_number", "place")


def item_functions(spark: SparkSession, sf_dir: str, tiles: int = 30) -> DataFrame:
    """Per item: rank of its name within its first letter, running and total number of items, number
    per first letter, next and previous item by name (id, name, two back), weight group."""
    items = sales.items(spark, sf_dir).withColumn("letter", first_letter("item_name"))
    by_name = with_position(
        items.select("item_id", "item_name"), [F.col("item_name"), F.col("item_id")], "_name_at",
        neighbours=[
            Neighbour("item_id", 1, "next_item_id"),
            Neighbour("item_id", -1, "previous_item_id"),
            Neighbour("item_name", 1, "next_item_name", "No items"),
            Neighbour("item_name", -2, "item_name_two_back", "No items"),
        ],
    ).drop("item_name", "_name_at")
    by_id = with_position(items.select("item_id"), [F.col("item_id")], "running_count", "total_count")
    by_weight = with_position(items.select("item_id", "weight"), [F.col("weight"), F.col("item_id")], "_weight_at", "_all")
    by_weight = by_weight.select("item_id", tile(F.col("_weight_at"), F.col("_all"), tiles).alias("weight_group"))
    counted = with_group_total(items, ["letter"], [F.count(F.lit(1)).alias("letter_count")])
    ranks = dense_ranks(items, ["letter"], "item_name", "name_rank")
    ranks = ranks.select(F.col("item_name").alias("_ranked_name"), "name_rank")
    ranked = join_per_key(counted, ranks, [("item_name", "_ranked_name")], "left")
    joined = ranked.join(by_name, "item_id").join(by_id, "item_id").join(by_weight, "item_id")
    return joined.select(
        "item_id", "item_name", "brand", "price", "name_rank", "running_count", "total_count", "letter_count",
        "next_item_id", "previous_item_id", "next_item_name", "item_name_two_back", "weight_group",
    ).orderBy("item_name", "item_id")


def last_customer_by_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers of each seller's last day of sales with the order's sum, one row per line.

    Each seller's last day comes first, one row per seller; the facts then meet those days only. The last days are few orders: they are
    stored, and sums are made for those orders only.
    """
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    lines = sales.lines(spark, sf_dir).select("order_id", "supplier_id", "line_no", "item_id")
    days = lines.select("order_id", "supplier_id").join(heads.select("order_id", "order_date"), "order_id")
    days = materialize(latest_values(days, ["supplier_id"], "order_date"))
    on_days = join_per_key(heads, days.select("_best").distinct(), [("order_date", "_best")], "left_semi")
    last = materialize(latest_rows(lines.join(on_days, "order_id"), ["supplier_id"], "order_date", days))
    wanted = keep_in(sales.lines(spark, sf_dir).select(F.col("order_id").alias("_sum_order"), "amount_cents"),
                     last.select(F.col("order_id").alias("_sum_order")), ["_sum_order"])
    sums = wanted.groupBy("_sum_order").agg(F.sum("amount_cents").alias("sum_cents"))
    people = sales.suppliers(spark, sf_dir).select("supplier_id", "supplier_name")
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    summed = join_per_key(last, sums, [("order_id", "_sum_order")], "left")
    named = lookup(lookup(summed, people, ["supplier_id"]), names, ["customer_id"])
    # The line's own key ends the sort, so that a range can be cut inside a seller with very many lines.
    return named.orderBy("supplier_name", "supplier_id", "order_id", "line_no", "item_id").select(
        F.col("supplier_id").alias("seller_id"), F.col("supplier_name").alias("seller_name"), "customer_id",
        "customer_name", "order_date", sales.money("sum_cents").alias("order_sum"),
    )


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = sales.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    sold = sales.lines(spark, sf_dir).select("order_id", "line_no", "item_id", "supplier_id", "unit_cents")
    return sold.join(heads, "order_id")


def top2_purchases_by_customer(spark: SparkSession, sf_dir: str, n: int = 2) -> DataFrame:
    """The n dearest purchases of each customer, latest first among equal prices. Names are joined after the cut."""
    order = [F.col("unit_cents").desc(), F.col("order_date").desc(), F.col("order_id"), F.col("line_no"),
             F.col("item_id"), F.col("supplier_id")]
    best = top_n_per_group(_purchases(spark, sf_dir), ["customer_id"], order, n)
    named = lookup(lookup(best, sales.customers(spark, sf_dir).select("customer_id", "customer_name"), ["customer_id"]),
                   sales.items(spark, sf_dir).select("item_id", "item_name"), ["item_id"])
    return named.select(
        "customer_id", "customer_name", "item_id", "item_name", sales.money("unit_cents").alias("unit_price"),
        "order_date", "place",
    ).distinct().orderBy("customer_id", "unit_price", "place")


def top2_prices_by_customer_apply(spark: SparkSession, sf_dir: str, n: int = 2) -> DataFrame:
    """For each customer the items bought at one of their n highest prices, on the last day they
    bought that item. Price ties are kept, so a customer may have more than n rows.

    For each customer, item and price only the last day matters; that table is stored, as both rankings
    read it. The price ranking leaves few rows, and last days are looked up for their items only.
    """
    prices = materialize(
        _purchases(spark, sf_dir).groupBy("customer_id", "item_id", "unit_cents").agg(F.max("order_date").alias("order_date")))
    highest = top_n_per_group(prices.select("customer_id", "unit_cents").distinct(), ["customer_id"], [F.col("unit_cents").desc()], n)
    dear = materialize(keep_in(prices, highest, ["customer_id", "unit_cents"]))
    last = keep_in(prices, dear, ["customer_id", "item_id"]).groupBy("customer_id", "item_id").agg(
        F.max("order_date").alias("order_date"))
    chosen = dear.join(last, ["customer_id", "item_id", "order_date"])
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    named = lookup(apply_rows(names, chosen, ["customer_id"]), sales.items(spark, sf_dir).select("item_id", "item_name"), ["item_id"])
    return named.select(
        "customer_id", "customer_name", "item_id", "item_name", sales.money("unit_cents").alias("top_price"),
        F.col("order_date").alias("last_date"),
    ).orderBy("customer_id", F.col("top_price").desc(), "item_id")


def customer_price_ranks(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """Purchases at one of each customer's n highest different prices (dense_rank <= n), all ties."""
    return within_top_values(_purchases(spark, sf_dir), ["customer_id"], "unit_cents", n).select(
        "customer_id", "order_id", "item_id", sales.money("unit_cents").alias("unit_price")
    )


def top2_orders_per_customer(spark: SparkSession, sf_dir: str, n: int = 2) -> DataFrame:
    """Each customer with their n largest orders (top-n per outer row)."""
    names = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    heads = sales.orders(spark, sf_dir).select("customer_id", "order_id", "total_cents")
    rows = top_n_per_outer(names, heads, ["customer_id"], [F.col("total_cents").desc(), F.col("order_id")], n)
    return rows.select("customer_id", "customer_name", "order_id", sales.money("total_cents").alias("order_total"))


def line_tiles(spark: SparkSession, sf_dir: str, tiles: int = 30) -> DataFrame:
    """All order lines in ``tiles`` groups of equal size by amount."""
    rows = sales.lines(spark, sf_dir).select("order_id", "line_no", "item_id", "supplier_id", "amount_cents")
    placed = with_position(rows, [F.col(c) for c in ["amount_cents", "order_id", "line_no", "item_id", "supplier_id"]], "_at", "_all")
    return placed.select(
        "order_id", "line_no", "item_id", "supplier_id", tile(F.col("_at"), F.col("_all"), tiles).alias("amount_group")
    )


def order_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by date with the id of the next order and the date two orders back."""
    rows = sales.orders(spark, sf_dir).select("order_id", "order_date")
    neighbours = [Neighbour("order_id", 1, "next_order_id"), Neighbour("order_date", -2, "date_two_back")]
    return with_position(rows, [F.col("order_date"), F.col("order_id")], "order_number", neighbours=neighbours)


def running_order_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the number and sum of orders up to and including its day (default RANGE frame)."""
    rows = sales.orders(spark, sf_dir).select("order_id", "order_date", "total_cents")
    run = running_sum(rows, "order_date", {"running_count": F.lit(1), "running_cents": F.col("total_cents")})
    return run.select("order_id", "order_date", "running_count", sales.money("running_cents").alias("running_total"))


def customer_name_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers ranked by name within their segment (dense_rank with a restart per segment)."""
    rows = sales.customers(spark, sf_dir).select("customer_id", "customer_name", "segment")
    return with_dense_rank(rows, ["segment"], "customer_name", "name_rank")


def line_share_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line with its order's sum and number of lines (aggregate over a partition)."""
    rows = sales.lines(spark, sf_dir).select("order_id", "line_no", "item_id", "supplier_id", "amount_cents")
    totals = [F.sum("amount_cents").alias("order_cents"), F.count(F.lit(1)).alias("order_lines")]
    return with_group_total(rows, ["order_id"], totals).select(
        "order_id", "line_no", "item_id", "supplier_id", "order_lines", sales.money("order_cents").alias("order_sum")
    )
