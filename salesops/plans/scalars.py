"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions import dates
from salesops.functions.texts import between_parentheses, concat_text, first_letter, trimmed
from salesops.sources import sales
from salesops.sources.tables import load


def order_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date function on every order."""
    day = F.col("order_date")
    return sales.orders(spark, sf_dir).select(
        "order_id",
        dates.date_text(day).alias("date_text"),
        dates.iso_text(day).alias("iso_text"),
        dates.month_name(day, "ru").alias("month_ru"),
        dates.month_name(day, "en").alias("month_en"),
        F.year(day).alias("date_year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("date_month"),
        dates.third_of_year(day).alias("third"),
        dates.month_end(day).alias("month_end"),
        dates.month_start(day).alias("month_start"),
        F.add_months(day, -1).alias("month_before"),
        dates.first_of_month(F.year(day), F.month(day)).alias("first_day"),
        dates.parse_date(dates.date_text(day)).alias("parsed"),
        dates.parse_date(F.col("priority")).alias("not_a_date"),
    )


def days_to_ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per number of days from order to shipping."""
    heads = sales.orders(spark, sf_dir).select("order_id", "order_date")
    sent = sales.lines(spark, sf_dir).groupBy("order_id", "ship_date").agg(F.count(F.lit(1)).alias("n"))
    return sent.join(heads, "order_id").groupBy(dates.days_between("order_date", "ship_date").alias("days")).agg(
        F.sum("n").alias("line_count"))


def item_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text function on every item."""
    label = concat_text(F.col("item_id"), F.lit(": "), F.col("item_name"), F.lit(" ("), F.col("brand"), F.lit(")"), F.lit(None))
    return sales.items(spark, sf_dir).withColumn("label", label).select(
        "item_id",
        "label",
        between_parentheses("label").alias("inside"),
        between_parentheses("item_name").alias("nothing_inside"),
        first_letter("item_name").alias("letter"),
        trimmed(F.concat(F.lit("  "), F.col("item_type"), F.lit(" "))).alias("trimmed_type"),
        F.col("weight").cast("string").alias("weight_text"),
        F.try_to_number(F.col("item_name"), F.lit("999")).cast("int").alias("no_number"),
        F.when(F.col("weight") > 25, F.lit("heavy")).otherwise(F.lit("light")).alias("weight_class"),
    )


def customer_names_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column dropped and a row filter on NULL and inequality."""
    return load(spark, sf_dir, "customer").drop("c_acctbal").filter(
        F.col("c_mktsegment").isNotNull() & (F.col("c_mktsegment") != "BUILDING"))
