"""XML, JSON and property-list reports on the item table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.texts import all_tags, concat_text, has_tag, json_fields, json_tags, properties
from salesops.operators.dml import merge
from salesops.sources import sales
from salesops.sources.storage import work_dir
from salesops.sources.tables import load
from salesops.sources.xml import (
    ITEM_COLUMNS, accepted_rows, item_documents, parse_xml_column, read_xml_items, rejected_documents, shred_xml, write_xml_items,
)


def stock_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item table in the columns of the item document, with its id."""
    return sales.items(spark, sf_dir).select(
        F.col("item_id").alias("StockItemID"),
        concat_text(F.col("item_name"), F.lit(" & "), F.col("item_id")).alias("StockItemName"),
        F.regexp_extract("brand", r"(\d+)", 1).cast("int").alias("SupplierID"),
        F.col("weight").alias("UnitPackageID"),
        F.lit(7).alias("OuterPackageID"),
        F.length("item_type").alias("QuantityPerOuter"),
        (F.col("weight") / 10).alias("TypicalWeightPerUnit"),
        F.col("weight").alias("LeadTimeDays"),
        F.col("item_name").like("cold%").cast("int").alias("IsChillerStock"),
        F.lit(15.0).alias("TaxRate"),
        F.col("price").alias("UnitPrice"),
    )


def xml_shred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item documents in a text column, back to flat rows."""
    return shred_xml(item_documents(stock_items(spark, sf_dir)), "document", keep=["StockItemID"])


def _damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item documents of which two in seven are spoilt: one is cut off, one is no XML."""
    kind = F.col("StockItemID") % 7
    cut = F.expr("left(document, length(document) - 30)")
    spoilt = F.when(kind == 3, cut).when(kind == 5, F.lit("no document")).otherwise(F.col("document"))
    return item_documents(stock_items(spark, sf_dir)).withColumn("document", spoilt)


def xml_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the well-formed documents."""
    keep = ["StockItemID"]
    return accepted_rows(parse_xml_column(_damaged_documents(spark, sf_dir), "document", keep), keep)


def xml_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the documents that were not taken."""
    keep = ["StockItemID"]
    return rejected_documents(parse_xml_column(_damaged_documents(spark, sf_dir), "document", keep), keep).select(*keep)


def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items exported to XML files and imported again."""
    path = work_dir(spark, "items-xml")
    write_xml_items(stock_items(spark, sf_dir).drop("StockItemID"), path)
    return read_xml_items(spark, path)


def _stock_and_delivery(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The stocked items (weight up to 40), and a delivery document of items from weight 20 with a new price."""
    items = stock_items(spark, sf_dir).withColumn("LastEditedBy", F.lit(0))
    stocked = items.filter(F.col("UnitPackageID") <= 40)
    delivered = items.filter(F.col("UnitPackageID") >= 20).withColumn("UnitPrice", F.col("UnitPrice") + 1)
    return stocked, shred_xml(item_documents(delivered), "document")


def _xml_merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stocked, delivery = _stock_and_delivery(spark, sf_dir)
    updates = {c: F.col(c) for c in ITEM_COLUMNS if c != "StockItemName"}
    return merge(stocked, delivery, ["StockItemName"], updates | {"LastEditedBy": F.lit(1)},
                 id_col="StockItemID", insert_defaults={"LastEditedBy": F.lit(1)})


def xml_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock after merging the delivery by item name."""
    return _xml_merged(spark, sf_dir)[0]


def xml_merge_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of that merge."""
    return _xml_merged(spark, sf_dir)[1].select(
        "action", F.col("old.StockItemID").alias("old_id"), F.col("new.StockItemID").alias("new_id"),
        F.col("new.StockItemName").alias("item_name"), F.col("old.UnitPrice").alias("old_price"),
        F.col("new.UnitPrice").alias("new_price"),
    )


def custom_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a custom-fields JSON text: country and tags. Old items have no tags, new items
    an empty list, and the text of hot items is cut short."""
    name = F.col("item_name")
    tags = F.concat(F.split(name, " "), F.array("item_type"))
    tags = F.when(name.like("old%"), F.lit(None)).when(name.like("new%"), F.slice(tags, 1, 0)).otherwise(tags)
    text = F.to_json(F.struct(F.col("brand").alias("CountryOfManufacture"), tags.alias("Tags")))
    cut = F.when(name.like("hot%"), F.lit('{"CountryOfManufacture')).otherwise(text)
    return sales.items(spark, sf_dir).select("item_id", "item_name", cut.alias("custom_fields"))


def json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country and first tag of each item; NULL where the text has none."""
    return custom_fields(spark, sf_dir).select("item_id", "item_name", *json_fields("custom_fields"))


def json_tag_filter(spark: SparkSession, sf_dir: str, tag: str = "ring") -> DataFrame:
    """Items that carry a tag, with all their tags in one field."""
    found = custom_fields(spark, sf_dir).filter(has_tag("custom_fields", tag))
    return found.select("item_id", "item_name", all_tags("custom_fields").alias("all_tags"))


def json_tag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item and tag, with the tag's place."""
    tags = custom_fields(spark, sf_dir).select("item_id", F.posexplode(json_tags("custom_fields")).alias("place", "tag"))
    return tags.select("item_id", "place", "tag")


def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in each event's JSON properties, summed per event type."""
    k = F.from_json("props", "k int")["k"]
    return load(spark, sf_dir, "events").groupBy("event_type").agg(
        F.sum(k).alias("sum_k"), F.max(k).alias("max_k"), F.count(k).alias("with_k"))


def property_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name=value list per customer, taken apart again; a name comes twice, its last value counts."""
    text = concat_text(F.lit("nation=0;segment="), F.col("segment"), F.lit(";nation="), F.col("nation_id"))
    found = sales.customers(spark, sf_dir).withColumn("extra_data", text).withColumn("_map", properties("extra_data"))
    return found.select(
        "customer_id", F.col("_map")["segment"].alias("segment"), F.try_element_at("_map", F.lit("nation")).cast("int").alias("nation_id"),
        F.try_element_at("_map", F.lit("absent")).alias("absent"),
    )
