"""Materialised intermediates, version directories, and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FOLDERS: dict[str, str] = {}  # application id -> temporary folder of a local session


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def _base(spark: SparkSession) -> str:
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not _is_local(context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_FOLDERS[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a session on ``local[...]``, where driver and executor are one process, may lack that setting; it
    gets a temporary folder. Any other session without it is an error. The context is not changed.
    """
    return f"{_base(spark)}/salesops/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a stored intermediate, once nothing that is still to run reads it."""
    work = f"/salesops/{df.sparkSession.sparkContext.applicationId}/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if work not in folder:
            raise ValueError(f"not a stored intermediate of this application: {folder}")
        delete_path(df.sparkSession, folder)


def drop_work(spark: SparkSession) -> None:
    """Delete the work folder of this application, once none of its results is needed any more."""
    delete_path(spark, f"{_base(spark)}/salesops/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back (select-into).

    The result is a plain Parquet scan: no lineage behind it, so a lost executor
    re-reads files instead of recomputing, and row placement can no longer change.
    """
    spark = df.sparkSession
    path = path or work_dir(spark, "table")
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Free the disk of finished shuffles between the phases of a long job.

    Spark removes a shuffle's files when the driver's JVM finds it unreachable, which it looks for only when it
    collects garbage; this asks for it, as ``spark.cleaner.periodicGC.interval`` does every half hour.
    """
    gc.collect()
    spark._jvm.System.gc()


def write_version(df: DataFrame, base: str, version: int) -> DataFrame:
    """Store a changed table next to its input as ``base/v=N``; the input is never overwritten."""
    return materialize(df, f"{base.rstrip('/')}/v={version}")


def empty_like(df: DataFrame) -> DataFrame:
    """An empty frame with the structure of ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)
