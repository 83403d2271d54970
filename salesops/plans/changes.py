"""Inserts, deletes, updates and merges on the customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.texts import concat_text
from salesops.operators.dml import delete_where, insert_rows, merge, update_all, update_from, update_where, with_defaults
from salesops.operators.predicates import like_any
from salesops.operators.toplimit import top_n
from salesops.sources import finance, sales
from salesops.sources.delimited import read_delimited, write_delimited
from salesops.sources.storage import empty_like, materialize, work_dir
from salesops.sources.tables import load

MARK = "Test customer name"


def _inserted(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """The customer table after inserting marked copies of its first n rows; ids go on after the highest."""
    table = load(spark, sf_dir, "customer")
    copies = top_n(table, [F.col("c_custkey")], n)
    copies = update_all(copies, {"c_name": concat_text(F.lit(MARK), F.lit(" "), F.col("c_custkey"))})
    return insert_rows(table, copies.drop("c_custkey"), "c_custkey", [F.col("c_name")])


def insert_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inserted(spark, sf_dir)


def insert_then_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts before and after the insert, and the marked rows among them."""
    before = load(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    return _inserted(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if(like_any("c_name", ["Test%"])).alias("marked_rows"),
    ).withColumn("rows_before", before)


def delete_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table without the marked row that ends in 1."""
    return delete_where(_inserted(spark, sf_dir), like_any("c_name", ["Test%1"]))


def update_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with '+id' added to the name of marked rows that contain a 3."""
    return update_where(
        _inserted(spark, sf_dir),
        like_any("c_name", ["Test%3%"]),
        {"c_name": concat_text(F.col("c_name"), F.lit("+"), F.col("c_custkey"))},
    )


def update_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with each customer's balance replaced by the sum of their orders (update from a join)."""
    paid = sales.orders(spark, sf_dir).groupBy(F.col("customer_id").alias("c_custkey")).agg(
        sales.money(F.sum("total_cents")).alias("paid"))
    return update_from(load(spark, sf_dir, "customer"), paid, ["c_custkey"], {"c_acctbal": "paid"})


def _merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    table = materialize(_inserted(spark, sf_dir))
    marked = table.filter(like_any("c_name", ["Test%"]))
    source = update_where(marked, like_any("c_name", ["Test%3"]), {"c_name": F.lit("Test MERGED record")}).drop("c_custkey")
    return merge(table, source, ["c_name"], {"c_name": F.col("c_name")}, id_col="c_custkey")


def merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge of the marked rows, one of them renamed: the renamed one is inserted, the others are updated."""
    return _merged(spark, sf_dir)[0]


def merge_customers_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its change log: action, old and new id and name."""
    return _merged(spark, sf_dir)[1].select(
        "action", F.col("old.c_custkey").alias("old_id"), F.col("old.c_name").alias("old_name"),
        F.col("new.c_custkey").alias("new_id"), F.col("new.c_name").alias("new_name"),
    )


def _parties(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers with positive balance, and the parties to merge into them: all customers and suppliers."""
    table = load(spark, sf_dir, "customer")
    parties = table.select("c_name", "c_nationkey", (F.col("c_acctbal") + 1).alias("c_acctbal")).unionByName(
        load(spark, sf_dir, "supplier").select(
            F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal")))
    return table.filter(F.col("c_acctbal") >= 0), parties


def merge_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge of whole tables by name: balances of known parties are updated, unknown parties are
    inserted with a default segment and the next ids."""
    target, source = _parties(spark, sf_dir)
    return merge(target, source, ["c_name"], {"c_acctbal": F.col("c_acctbal")}, id_col="c_custkey",
                 insert_defaults={"c_mktsegment": F.lit("NEW")})[0]


def merge_parties_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that merge did, per action: rows, highest id, balance change in cents."""
    target, source = _parties(spark, sf_dir)
    log = merge(target, source, ["c_name"], {"c_acctbal": F.col("c_acctbal")}, id_col="c_custkey",
                insert_defaults={"c_mktsegment": F.lit("NEW")})[1]
    change = sales.cents(F.col("new.c_acctbal")) - F.coalesce(sales.cents(F.col("old.c_acctbal")), F.lit(0))
    return log.groupBy("action").agg(
        F.count(F.lit(1)).alias("changed_rows"), F.max("new.c_custkey").alias("max_id"), F.sum(change).alias("change_cents"))


def delimited_roundtrip(spark: SparkSession, sf_dir: str, encoding: str = "UTF-8") -> DataFrame:
    """The customer table exported to delimited text and imported into an empty copy of its structure."""
    table = load(spark, sf_dir, "customer")
    path = work_dir(spark, "delimited")
    write_delimited(table, path, encoding=encoding)
    recovered = empty_like(table)
    return recovered.unionByName(read_delimited(spark, path, recovered.schema, encoding=encoding))


def delimited_roundtrip_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a two-byte encoding, as the original exchange has it."""
    return delimited_roundtrip(spark, sf_dir, "UTF-16LE")


def delimited_documents(spark: SparkSession, sf_dir: str, encoding: str = "UTF-16LE") -> DataFrame:
    """Texts with line breaks through the two-byte exchange, in files of bounded size."""
    table = load(spark, sf_dir, "documents")
    path = work_dir(spark, "delimited")
    write_delimited(table, path, encoding=encoding, escaped=True, rows_per_file=20_000)
    return read_delimited(spark, path, table.schema, encoding=encoding, escaped=True)


def new_dictionary_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients entered with the defaults of the run's own day, compared with that day."""
    rows = sales.customers(spark, sf_dir).select("customer_id", "customer_name")
    filled = with_defaults(rows, finance.dictionary_defaults())
    return filled.select("customer_id", (F.col("create_date") == F.current_date()).alias("created_today"), "valid_to", "is_del")


def materialized_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Select-into: the distinct buyers' rows stored as a table and read back, without generated columns."""
    buyers = sales.orders(spark, sf_dir).select(F.col("customer_id").alias("c_custkey")).distinct()
    return materialize(load(spark, sf_dir, "customer").join(buyers, "c_custkey", "left_semi").drop("c_acctbal"))
