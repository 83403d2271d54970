"""The sales model: orders, order lines, customers, items, people, nations.

Money is carried as whole cents (bigint), so sums do not depend on the order in
which partial results meet and a retried task cannot change a total or a rank.
``money()`` turns cents back into a number for output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.sources.tables import load


def cents(amount: Column) -> Column:
    return F.rint(amount * 100).cast("bigint")


def money(cents_col: Column | str) -> Column:
    col = F.col(cents_col) if isinstance(cents_col, str) else cents_col
    return col.cast("double") / 100


def _months(df: DataFrame) -> list[str]:
    """The months of the dates, where the table is stored by month."""
    names = {"o_orderdate_month": "order_ts_month", "l_shipdate_month": "ship_ts_month"}
    return [f"{c} AS {n}" for c, n in names.items() if c in df.columns]


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, which is also its invoice. ``order_ts`` is the raw
    column: range predicates on it reach the Parquet scan."""
    table = load(spark, sf_dir, "orders")
    return table.selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderdate AS order_ts",
        "to_date(o_orderdate) AS order_date",
        "o_orderstatus AS status",
        "o_orderstatus = 'F' AS picked",
        "CAST(rint(o_totalprice * 100) AS BIGINT) AS total_cents",
        "o_orderpriority AS priority",
        *_months(table),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line; unit price is the amount per piece, rounded half up to a cent."""
    table = load(spark, sf_dir, "lineitem")
    return table.selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS line_no",
        "l_partkey AS item_id",
        "l_suppkey AS supplier_id",
        "CASE WHEN l_quantity = floor(l_quantity) THEN CAST(l_quantity AS BIGINT) WHEN l_quantity IS NOT NULL"
        " THEN CAST(raise_error('quantity is no whole number') AS BIGINT) END AS quantity",
        "CAST(rint(l_extendedprice * 100) AS BIGINT) AS amount_cents",
        "floor(try_divide(CAST(rint(l_extendedprice * 100) AS BIGINT), l_quantity) + 0.5D) AS unit_cents",
        "l_shipdate AS ship_ts",
        "to_date(l_shipdate) AS ship_date",
        "l_returnflag AS return_flag",
        *_months(table),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id", "c_name AS customer_name", "c_nationkey AS nation_id", "c_mktsegment AS segment",
        "c_acctbal AS balance",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").selectExpr(
        "p_partkey AS item_id", "p_name AS item_name", "p_brand AS brand", "p_type AS item_type", "p_size AS weight",
        "p_retailprice AS price",
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, who also stand for the sales people of the lines they ship."""
    return load(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS supplier_id", "s_name AS supplier_name", "s_nationkey AS nation_id")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS nation_id", "n_name AS nation_name", "n_regionkey AS region_id")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "region").selectExpr("r_regionkey AS region_id", "r_name AS region_name")


def order_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount and pieces per order.

    Aggregated before any join: partial sums are combined on the map side, so an
    order that holds a large share of all lines costs one row per map task.
    """
    return (
        lines(spark, sf_dir)
        .groupBy("order_id")
        .agg(F.sum("amount_cents").alias("sum_cents"), F.sum("quantity").alias("sum_quantity"))
    )
