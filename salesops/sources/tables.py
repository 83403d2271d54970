"""Named Parquet tables with declared schemas (no inference, no footer job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


CATALOG = "catalog:"
MONTHS = "months:"  # folder of facts stored by month, "|", where the other tables are
BY_MONTH = {"orders": "o_orderdate_month date", "lineitem": "o_orderdate_month date, l_shipdate_month date"}
ORDER_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one named table; columns and filters are pruned and pushed by Catalyst.

    ``sf_dir`` is a directory of Parquet tables, ``catalog:schema`` for the tables of a catalog schema, or what
    ``facts.store_by_month`` returns: facts then have the months of their dates as further columns.
    """
    if sf_dir.startswith(MONTHS):
        folder, other = sf_dir.removeprefix(MONTHS).split("|", 1)
        if name not in BY_MONTH:
            return load(spark, other, name)
        return spark.read.schema(f"{SCHEMAS[name]}, {BY_MONTH[name]}").parquet(f"{folder.rstrip('/')}/{name}.parquet")
    if sf_dir.startswith(CATALOG):
        return spark.table(f"{sf_dir.removeprefix(CATALOG)}.{name}")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def store_bucketed(spark: SparkSession, sf_dir: str, schema: str, path: str, buckets: int) -> str:
    """Store the tables as catalog tables and return the ``catalog:`` name to load them by.

    Orders and lines are bucketed and sorted by the order key. Nearly every report joins or sums them by
    that key, and on this layout does so without a shuffle. Rows are first shuffled into their buckets, so that
    each bucket is one file.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name in SCHEMAS:
        df = load(spark, sf_dir, name)
        writer = df.write
        if name in ORDER_KEYS:
            key = ORDER_KEYS[name]
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.format("parquet").option("path", f"{path.rstrip('/')}/{name}").saveAsTable(f"{schema}.{name}")
    return f"{CATALOG}{schema}"
