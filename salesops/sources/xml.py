"""XML import, shredding and export of items, and XML messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.sources.storage import materialize

# The item document's element names and types.
PACKAGE = "struct<UnitPackageID:int,OuterPackageID:int,QuantityPerOuter:int,TypicalWeightPerUnit:double>"
ITEM = (
    f"_Name string, SupplierID int, Package {PACKAGE}, LeadTimeDays int, IsChillerStock int, "
    "TaxRate double, UnitPrice double"
)
ITEM_COLUMNS = [
    "StockItemName", "SupplierID", "UnitPackageID", "OuterPackageID", "QuantityPerOuter",
    "TypicalWeightPerUnit", "LeadTimeDays", "IsChillerStock", "TaxRate", "UnitPrice",
]
CORRUPT = "_corrupt_record"
ITEMS_PER_FILE = 50_000  # some 25 MB; an XML file is read whole by one task


def _flatten(item: str = "") -> list[Column]:
    at = f"{item}." if item else ""
    inner = {"UnitPackageID", "OuterPackageID", "QuantityPerOuter", "TypicalWeightPerUnit"}
    cols = [F.trim(F.col(f"{at}_Name")).alias("StockItemName")]
    for name in ITEM_COLUMNS[1:]:
        cols.append(F.col(f"{at}Package.{name}" if name in inner else f"{at}{name}").alias(name))
    return cols


def parse_xml_items(spark: SparkSession, path: str) -> DataFrame:
    """Item files parsed and stored, with the text of malformed items in ``_corrupt_record``.

    Files are cut at the row tag, not loaded as one document. The parse is stored whole: a
    pruned parse would not look at the columns a query leaves out, and so miss their errors.
    """
    return materialize(
        spark.read.format("xml")
        .schema(f"{ITEM}, {CORRUPT} string")
        .option("rowTag", "Item")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .load(path)
    )


def accepted_items(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).select(*_flatten())


def rejected_items(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("rejected_text"))


def read_xml_items(spark: SparkSession, path: str) -> DataFrame:
    """Item files to flat rows; malformed items are left out (see ``rejected_items``)."""
    return accepted_items(parse_xml_items(spark, path))


def parse_xml_column(df: DataFrame, xml_col: str, keep: list[str] | None = None) -> DataFrame:
    """A column of item documents parsed and stored: ``keep``, the document (NULL where malformed) and its text where rejected.

    A document is rejected as a whole if it is cut off, no XML, or holds text where a number belongs. The parse is stored
    whole, so that a query that leaves columns out sees the same errors.
    """
    document = f"Item array<struct<{_as_struct(ITEM)}>>, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(*(keep or []), F.col(xml_col).alias("_text"), F.from_xml(xml_col, document, options).alias("_doc"))
    bad = F.col("_text").isNotNull() & (F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull())
    return materialize(parsed.select(*(keep or []), "_doc", F.when(bad, F.col("_text")).alias(CORRUPT)))


def accepted_rows(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The items of accepted documents as flat rows, one per Item element."""
    rows = parsed.filter(F.col(CORRUPT).isNull()).select(*(keep or []), F.explode("_doc.Item").alias("_item"))
    return rows.select(*(keep or []), *_flatten("_item"))


def rejected_documents(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(*(keep or []), F.col(CORRUPT).alias("rejected_text"))


def shred_xml(df: DataFrame, xml_col: str, keep: list[str] | None = None) -> DataFrame:
    """A column of item documents to flat rows, one per Item element; a malformed document fails the job.

    ``parse_xml_column`` takes such documents out and reports them instead.
    """
    document = f"Item array<struct<{_as_struct(ITEM)}>>, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(*(keep or []), F.col(xml_col).alias("_text"), F.from_xml(xml_col, document, options).alias("_doc"))
    bad = F.col("_text").isNotNull() & (F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull())
    items = F.when(bad, F.raise_error(F.concat(F.lit("malformed item document: "), F.left("_text", F.lit(200))))).otherwise(F.col("_doc.Item"))
    rows = parsed.select(*(keep or []), F.explode(items).alias("_item"))
    return rows.select(*(keep or []), *_flatten("_item"))


def _as_struct(ddl: str) -> str:
    """Column list to struct members: ``name type`` becomes ``name:type``."""
    parts = ddl.replace(PACKAGE, "@").split(", ")
    return ",".join(p.replace(" ", ":", 1) for p in parts).replace("@", PACKAGE)


def item_struct(attribute: str = "Name") -> Column:
    """The nested shape of one Item from flat columns; the name is an attribute."""
    package = F.struct("UnitPackageID", "OuterPackageID", "QuantityPerOuter", "TypicalWeightPerUnit")
    return F.struct(
        F.col("StockItemName").alias(f"_{attribute}"), F.col("SupplierID"), package.alias("Package"),
        F.col("LeadTimeDays"), F.col("IsChillerStock"), F.col("TaxRate"), F.col("UnitPrice"),
    )


def item_documents(df: DataFrame, xml_col: str = "document") -> DataFrame:
    """Add the document text of each item row."""
    body = F.to_xml(item_struct(), {"rowTag": "Item"})
    return df.withColumn(xml_col, F.concat(F.lit("<StockItems>"), body, F.lit("</StockItems>")))


def write_xml_items(df: DataFrame, path: str, attribute: str = "Name") -> None:
    """Item rows to files of one StockItems document each, of ITEMS_PER_FILE items at most.

    The text is many times as large as the rows it is made of, so rows are spread evenly over the writing tasks, however few
    tasks read them, and the number of files grows with the rows: no task writes or reads a share of them.
    """
    (
        df.select(item_struct(attribute).alias("_item"))
        .select("_item.*")
        .hint("rebalance")
        .write.format("xml")
        .option("maxRecordsPerFile", ITEMS_PER_FILE)
        .option("rootTag", "StockItems")
        .option("rowTag", "Item")
        .mode("errorifexists")
        .save(path)
    )


def to_request_xml(df: DataFrame, columns: list[str], body: str = "body") -> DataFrame:
    """Add a request message made of the given columns of the row."""
    params = F.to_xml(F.struct(*columns), {"rowTag": "Params"})
    return df.withColumn(body, F.concat(F.lit("<RequestMessage>"), params, F.lit("</RequestMessage>")))
