"""Files, XML and JSON, stored tables."""

import glob

import pytest
from pyspark.sql import functions as F

from salesops.plans.documents import stock_items
from salesops.functions.texts import all_tags, has_tag, json_fields, properties
from salesops.sources import xml
from salesops.sources.delimited import SEPARATOR, read_delimited, write_delimited
from salesops.sources.storage import empty_like, materialize, work_dir
from salesops.sources.tables import SCHEMAS, load, schema_of
from salesops.sources.xml import (
    accepted_items, accepted_rows, item_documents, parse_xml_column, parse_xml_items, read_xml_items, rejected_documents, rejected_items, shred_xml,
    to_request_xml, write_xml_items,
)
from tests.conftest import SF, rows

ITEMS = (
    "StockItemName string, SupplierID int, UnitPackageID int, OuterPackageID int, QuantityPerOuter int, "
    "TypicalWeightPerUnit double, LeadTimeDays int, IsChillerStock int, TaxRate double, UnitPrice double"
)


def test_declared_schemas_match_the_files(spark, sf):
    for name in SCHEMAS:
        assert load(spark, sf, name).schema == spark.read.parquet(f"{sf}/{name}.parquet").schema == schema_of(name)


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16LE"])
def test_delimited_roundtrip(spark, tmp_path, encoding):
    data = [(1, "plain", 1.5), (2, None, None), (3, "quo\"te, comma", -2.0), (4, "Жук 250г", 0.0), (5, "$%#@ nearly", 7.25), (6, "", 1.0), (7, " two\tblanks ", None)]
    df = spark.createDataFrame(data, "id int, name string, v double")
    path = str(tmp_path / encoding)
    write_delimited(df, path, encoding=encoding)
    assert rows(read_delimited(spark, path, df.schema, encoding=encoding)) == sorted(data, key=repr)
    text = b"".join(open(f, "rb").read() for f in glob.glob(f"{path}/part-*")).decode(encoding)
    assert SEPARATOR in text


def test_blank_field_is_null_and_bad_number_fails(spark, tmp_path):
    (tmp_path / "in.txt").write_text(f"1{SEPARATOR}{SEPARATOR}2.5\n2{SEPARATOR}x{SEPARATOR}\n")
    got = read_delimited(spark, str(tmp_path / "in.txt"), "id int, name string, v double")
    assert rows(got) == [(1, None, 2.5), (2, "x", None)]
    (tmp_path / "bad.txt").write_text(f"one{SEPARATOR}x{SEPARATOR}1\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|FAILED_READ_FILE"):
        read_delimited(spark, str(tmp_path / "bad.txt"), "id int, name string, v double").collect()


def test_xml_file_roundtrip_and_attribute(spark, tmp_path):
    df = spark.createDataFrame(
        [("A & B <c>", 4, 7, 7, 1, 0.05, 14, 0, 15.0, 25.0), ("plain", 5, None, 7, None, None, 1, 1, None, 2.5)], ITEMS)
    write_xml_items(df, str(tmp_path / "x"))
    assert rows(read_xml_items(spark, str(tmp_path / "x"))) == rows(df)
    write_xml_items(df, str(tmp_path / "y"), attribute="ItemName")
    assert 'ItemName="plain"' in "".join(open(f).read() for f in glob.glob(str(tmp_path / "y" / "part-*")))


def test_xml_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(xml, "ITEMS_PER_FILE", 10)
    df = spark.range(95, numPartitions=1).selectExpr(
        "concat('item ', id) AS StockItemName", "int(id) AS SupplierID", "7 AS UnitPackageID", "7 AS OuterPackageID", "1 AS QuantityPerOuter",
        "0.5D AS TypicalWeightPerUnit", "14 AS LeadTimeDays", "0 AS IsChillerStock", "15.0D AS TaxRate", "2.5D AS UnitPrice")
    write_xml_items(df, str(tmp_path / "x"))
    held = [open(f).read().count("<Item ") for f in glob.glob(str(tmp_path / "x" / "part-*"))]
    assert sum(held) == 95 and max(held) <= 10
    assert rows(read_xml_items(spark, str(tmp_path / "x"))) == rows(df)


def test_xml_rejects_malformed_items(spark, tmp_path):
    (tmp_path / "items.xml").write_text(
        '<StockItems><Item Name=" ok "><SupplierID>4</SupplierID></Item>'
        '<Item Name="bad"><SupplierID>four</SupplierID></Item></StockItems>')
    path = str(tmp_path / "items.xml")
    parsed = parse_xml_items(spark, path)
    assert [r.StockItemName for r in accepted_items(parsed).select("StockItemName").collect()] == ["ok"]
    rejected = rejected_items(parsed).collect()
    assert len(rejected) == 1 and "four" in rejected[0].rejected_text


def test_xml_column_with_many_items(spark):
    document = (
        '<StockItems><Item Name="x"><SupplierID>1</SupplierID><Package><UnitPackageID>7</UnitPackageID></Package></Item>'
        '<Item Name="y"><SupplierID>2</SupplierID></Item></StockItems>')
    docs = spark.createDataFrame([(1, document), (3, None), (4, "<StockItems></StockItems>")], "id int, doc string")
    got = shred_xml(docs, "doc", keep=["id"]).select("id", "StockItemName", "SupplierID", "UnitPackageID")
    assert rows(got) == [(1, "x", 1, 7), (1, "y", 2, None)]


def test_request_message(spark):
    df = to_request_xml(spark.createDataFrame([(5,)], "CustomerID int"), ["CustomerID"])
    assert "".join(df.first().body.split()) == "<RequestMessage><Params><CustomerID>5</CustomerID></Params></RequestMessage>"


def test_json_edge_cases(spark):
    texts = [
        '{"CountryOfManufacture": "Peru", "Tags": ["Old", "Quite New"]}', '{"Tags": []}', '{"CountryOfManufacture": "X"}',
        None, "{broken", '{"Tags": ["old"]}', '{"Tags": null}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: (r.country, r.first_tag) for r in df.select("id", *json_fields("t")).collect()}
    assert got == {0: ("Peru", "Old"), 1: (None, None), 2: ("X", None), 3: (None, None), 4: (None, None), 5: (None, "old"), 6: (None, None)}
    assert [r.id for r in df.filter(has_tag("t", "Old")).collect()] == [0]
    assert {r.id: r.x for r in df.select("id", all_tags("t").alias("x")).collect()} == {
        0: "Old, Quite New", 1: None, 2: None, 3: None, 4: None, 5: "old", 6: None}


def test_properties(spark):
    df = spark.createDataFrame([("a=1;b=x",), ("",), (None,), ("a=1;b=2;a=3;c",), ("a=b=c;a=",)], "t string")
    assert [r[0] for r in df.select(properties("t")).collect()] == [{"a": "1", "b": "x"}, {"": None}, None, {"b": "2", "a": "3", "c": None}, {"a": ""}]


def test_line_breaks_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="line break"):
        write_delimited(spark.createDataFrame([("a\nb", 1)], "t string, `n.m` int"), str(tmp_path / "x"))


def test_malformed_documents_are_reported(spark):
    good = item_documents(stock_items(spark, SF).limit(2)).select("document").collect()
    texts = [good[0][0], good[1][0], good[0][0][:-30], "junk", good[1][0].replace("<LeadTimeDays>", "<LeadTimeDays>x"), None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    parsed = parse_xml_column(df, "t", ["id"])
    assert {r.id for r in accepted_rows(parsed, ["id"]).collect()} == {0, 1}
    assert {r.id: r.rejected_text for r in rejected_documents(parsed, ["id"]).collect()} == {i: texts[i] for i in (2, 3, 4)}
    with pytest.raises(Exception, match="malformed"):
        shred_xml(df, "t", ["id"]).select("StockItemName").collect()


def test_empty_copy_and_stored_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    assert empty_like(df).schema == df.schema and empty_like(df).count() == 0
    stored = materialize(df)
    assert rows(stored) == rows(df) and stored.schema == df.schema
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = work_dir(spark, "t"), work_dir(spark, "t")
    assert first != second
    if base:
        assert first.startswith(base.rstrip("/") + "/salesops/" + spark.sparkContext.applicationId)


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16LE"])
def test_any_text_through_the_escaped_exchange(spark, tmp_path, encoding):
    texts = ["a\nb", "\r\n", "^", "^n", "^c^r", SEPARATOR, f"x{SEPARATOR}\ny", 'quo"te\n"', "\\n", "\\", "end\\", "", None, " ", "Жук\n😀", '"', ",\t"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 20)], "`n.m` int, t string").repartition(1)
    path = str(tmp_path / "x")
    write_delimited(df, path, encoding=encoding, escaped=True, rows_per_file=50)
    back = read_delimited(spark, path, df.schema, encoding=encoding, escaped=True)
    assert rows(back) == rows(df)
    assert len(glob.glob(f"{path}/part-*")) == 7 and len({r[0] for r in back.select(F.spark_partition_id()).distinct().collect()}) > 1
