"""Session builder for local runs (tests, bench). Clusters bring their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session with AQE on, UTC dates and a shuffle width equal to the cores."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("salesops")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
