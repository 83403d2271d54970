"""Facts laid out by month, and the filters that make Spark skip the months a report does not need.

A date column ``d`` of such a table has a companion ``d_month``, the first day of its month, by which the files are partitioned.
``predicates.in_period`` puts a period on the companion as well, so other months are not listed; ``in_months_of`` prunes one
table by the months that occur in another one, at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.operators.skew import join_per_key
from salesops.sources.tables import MONTHS, load

# table: its own date column; table: (key, other table, its key, its date column) whose month it carries along
DATES = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
CARRIED = {"lineitem": ("l_orderkey", "orders", "o_orderkey", "o_orderdate")}


def month_of(col: str) -> str:
    return f"{col}_month"


def with_month(df: DataFrame, col: str) -> DataFrame:
    """The companion of a date column; null for a null date, which gets a partition of its own."""
    return df.withColumn(month_of(col), F.trunc(F.col(col).cast("date"), "MM"))


def write_by_month(df: DataFrame, col: str, path: str) -> None:
    """Files per month. Rows are rebalanced by month first: Spark splits a month too large for one task and joins small ones,
    so the number of files follows the data."""
    month = month_of(col)
    df.hint("rebalance", month).write.partitionBy(month).parquet(path)


def store_by_month(spark: SparkSession, sf_dir: str, path: str, tables: tuple[str, ...] = tuple(DATES)) -> str:
    """Store fact tables by month under ``path``; returns the name by which ``tables.load`` finds them, with all other tables in ``sf_dir``.

    A line is stored by its shipping month and carries the month of its order, so that a join by order can name the
    order's month too. A line without an order carries null.
    """
    for name in tables:
        df = with_month(load(spark, sf_dir, name), DATES[name])
        if name in CARRIED:
            key, other, other_key, date = CARRIED[name]
            months = with_month(load(spark, sf_dir, other), date).select(F.col(other_key).alias("_key"), month_of(date))
            df = join_per_key(df, months, [(key, "_key")], "left").drop("_key")
        write_by_month(df, DATES[name], f"{path.rstrip('/')}/{name}.parquet")
    return f"{MONTHS}{path}|{sf_dir}"


def in_months_of(df: DataFrame, other: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` whose month occurs in ``other``, where both have the month of ``col``; else ``df`` as it is.

    The months are at most one row per calendar month, so they are broadcast whatever the size of ``other``. As the month is
    the partition column of ``df``, Spark reads the partitions of these months only. A null month meets nothing.
    """
    month = month_of(col)
    if month not in df.columns or month not in other.columns:
        return df
    months = F.broadcast(other.select(F.col(month).alias("_month")).distinct())
    return df.join(months, df[month] == months["_month"], "left_semi")
