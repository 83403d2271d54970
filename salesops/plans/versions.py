"""Changes of stored tables that rewrite touched files only, and identities that are not given out twice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.texts import concat_text
from salesops.operators.predicates import in_period
from salesops.operators.toplimit import top_n
from salesops.sources import sales
from salesops.sources.facts import month_of, with_month
from salesops.sources.storage import work_dir
from salesops.sources.tables import load
from salesops.sources.versions import VersionedTable

DATE = "o_orderdate"


def postings_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Orders as a versioned table with files per month."""
    return VersionedTable.create(with_month(load(spark, sf_dir, "orders"), DATE), work_dir(spark, "postings"), [month_of(DATE)])


def month_delta(spark: SparkSession, sf_dir: str, year: int = 1997, month: int = 1) -> DataFrame:
    """What comes in for one month: its orders with a cent more, and the finished ones again under an unknown key."""
    first = dt.date(year, month, 1)
    rows = in_period(load(spark, sf_dir, "orders"), DATE, first, (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1))
    total = sales.money(sales.cents(F.col("o_totalprice")) + 1).alias("o_totalprice")
    rest = [c for c in rows.columns if c not in ("o_orderkey", "o_totalprice")]
    same, again = rows.select("o_orderkey", total, *rest), rows.where("o_orderstatus = 'F'").select((-1 - F.col("o_orderkey")).alias("o_orderkey"), total, *rest)
    return with_month(same.unionByName(again), DATE)


def merge_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings after a merge that concerns one month: only that month's files are written anew."""
    table = postings_table(spark, sf_dir)
    table.merge(month_delta(spark, sf_dir), ["o_orderkey"], {"o_totalprice": F.col("o_totalprice")})
    return table.read().drop(month_of(DATE)).withColumn(DATE, F.to_date(DATE))


def merge_month_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that merge did, per action: rows, lowest key, change in cents."""
    table = postings_table(spark, sf_dir)
    _, log = table.merge(month_delta(spark, sf_dir), ["o_orderkey"], {"o_totalprice": F.col("o_totalprice")})
    change = sales.cents(F.col("new.o_totalprice")) - F.coalesce(sales.cents(F.col("old.o_totalprice")), F.lit(0))
    return log.groupBy("action").agg(F.count(F.lit(1)).alias("changed_rows"), F.min("new.o_orderkey").alias("lowest_key"), F.sum(change).alias("change_cents"))


def correct_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month corrected (priorities cleared) and the next one's unfinished postings deleted: per status, rows and cleared ones of the last version
    and of the first, which is still there."""
    table = postings_table(spark, sf_dir)
    month = F.col(month_of(DATE))
    table.update_where(month == F.lit(dt.date(1997, 1, 1)), {"o_orderpriority": F.lit(None).cast("string")})
    table.delete_where((month == F.lit(dt.date(1997, 2, 1))) & (F.col("o_orderstatus") != "F"))

    def counts(version: int | None, name: str) -> DataFrame:
        return table.read(version).groupBy(F.col("o_orderstatus").alias("status")).agg(
            F.count(F.lit(1)).alias(f"{name}_rows"), F.count_if(F.col("o_orderpriority").isNull()).alias(f"{name}_cleared"))

    return counts(0, "first").join(counts(None, "last"), "status")


def insert_after_delete(spark: SparkSession, sf_dir: str, mark: str = "Test customer name") -> DataFrame:
    """Customers after the last one was deleted and five marked copies were inserted: the deleted id is not given out again."""
    customers = load(spark, sf_dir, "customer")
    table = VersionedTable.create(customers, work_dir(spark, "customers"), id_col="c_custkey")
    table.delete_where(F.col("c_custkey") == table.latest().last_id)
    copies = top_n(customers, [F.col("c_custkey")], 5)
    copies = copies.withColumn("c_name", concat_text(F.lit(mark), F.lit(" "), F.col("c_custkey"))).drop("c_custkey")
    for _ in range(2):  # the second call, as after a lost answer, changes nothing
        table.insert(copies, [F.col("c_name")], token="marked copies")
    return table.read()
