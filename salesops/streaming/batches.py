"""Finished batches of a streaming job: which are visible, reading them, and merging their many small folders into one.

A job writes ``<table>/batch_id=N`` folders and, last, ``state/batch_id=N``; a batch is visible once its state is there. ``compact`` writes
the visible batches of each table to ``merged/<table>/upto=N`` and then a manifest ``manifest/v=K`` that says N. Readers take the merged
rows of the newest manifest and the folders of later batches, so a batch is seen once, before, during and after a compaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.sources.storage import delete_path, path_exists

STATE = "last_id bigint"
_MANIFEST = "upto int, v int"


def visible_batches(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch_id, last_id) of the batches whose state is still in a folder of its own."""
    return spark.read.schema(f"{STATE}, batch_id int").parquet(f"{out_dir.rstrip('/')}/state")


def merged_upto(spark: SparkSession, out_dir: str) -> tuple[int, int]:
    """(version, last merged batch) of the newest manifest; (-1, -1) before the first."""
    base = f"{out_dir.rstrip('/')}/manifest"
    if not path_exists(spark, base):
        return -1, -1
    row = spark.read.schema(_MANIFEST).parquet(base).orderBy(F.col("v").desc()).first()
    return (row.v, row.upto) if row else (-1, -1)


def read_batches(spark: SparkSession, out_dir: str, table: str, schema: str, after: int = -1) -> DataFrame:
    """The rows of a table's visible batches, with ``batch_id``; of the batches later than ``after`` only, where given."""
    base = out_dir.rstrip("/")
    _, upto = merged_upto(spark, base)
    done = visible_batches(spark, base).where(F.col("batch_id") > max(upto, after)).select("batch_id")
    fresh = spark.read.schema(f"{schema}, batch_id int").parquet(f"{base}/{table}").where(F.col("batch_id") > max(upto, after))
    rows = fresh.join(done, "batch_id", "left_semi").select("batch_id", *fresh.drop("batch_id").columns)
    if upto < 0 or upto <= after:
        return rows
    merged = spark.read.schema(f"{schema}, batch_id int").parquet(f"{base}/merged/{table}/upto={upto}").where(F.col("batch_id") > after)
    return rows.unionByName(merged)


def last_visible(spark: SparkSession, out_dir: str) -> int:
    """The latest visible batch, -1 if there is none. Batches end in order."""
    if not path_exists(spark, f"{out_dir.rstrip('/')}/state"):
        return -1
    top = visible_batches(spark, out_dir).agg(F.max("batch_id")).first()[0]
    return merged_upto(spark, out_dir)[1] if top is None else top


def compact(spark: SparkSession, out_dir: str, tables: dict[str, str]) -> int:
    """Merge all visible batches of ``tables`` (name: schema); the last merged batch.

    May run next to the job and its readers. What the new manifest replaces stays until the next compaction, which deletes it: a reader that began
    with the manifest before still finds all its files. A compaction that is cut off leaves no manifest and is done anew. The last state
    stays, as the job's next batch goes on from it. Number and size of the merged files are Spark's choice (rebalanced partitions).
    """
    base = out_dir.rstrip("/")
    version, before = merged_upto(spark, base)
    upto = last_visible(spark, base)
    if upto <= before:
        return before
    for name, schema in tables.items():
        rows = read_batches(spark, base, name, schema).where(F.col("batch_id") <= upto)
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{base}/merged/{name}/upto={upto}")
    spark.createDataFrame([(upto,)], "upto int").coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/v={version + 1}")
    # no reader of the manifest just replaced needs the folders that were merged before it
    for name in [*tables, "state"]:
        folders = spark.read.schema("batch_id int").parquet(f"{base}/{name}").where(F.col("batch_id") <= before).select("batch_id").distinct()
        for row in folders.collect():  # one name per folder
            delete_path(spark, f"{base}/{name}/batch_id={row.batch_id}")
    if version > 0:
        earlier = spark.read.schema(_MANIFEST).parquet(f"{base}/manifest").where(F.col("v") == version - 1).first()
        if earlier is not None and earlier.upto >= 0:
            for name in tables:
                delete_path(spark, f"{base}/merged/{name}/upto={earlier.upto}")
    return upto
