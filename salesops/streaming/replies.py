"""The sender's side of the request stream: replies are received and matched with the requests that still wait.

A second streaming query reads the sent messages and wakes up when the report job ends a batch. Its state is two tables, written anew
in every batch: requests without a reply, and replies whose request was not seen yet. Answered requests leave the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesops.operators.skew import join_per_key
from salesops.streaming.batches import STATE, last_visible, read_batches
from salesops.streaming.requests import REPLY, replied_id

OPEN = "request_id bigint"
EARLY = "request_id bigint, report_id bigint"
ANSWERED = EARLY


def reply_ids(replies: DataFrame) -> DataFrame:
    """(request_id, report_id) of reply messages."""
    return replies.select("request_id", replied_id("body").alias("report_id"))


def receive_batch(spark: SparkSession, report_dir: str, out_dir: str) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch: what was sent and what was replied since the batch before.

    Replies are taken from the report job's visible batches after the last one received, so a batch that is rewritten or merged meanwhile
    is received once. The tables of a batch are overwritten when it is replayed; ``state`` is written last.
    """
    base = out_dir.rstrip("/")

    def path(table: str, batch_id: int) -> str:
        return f"{base}/{table}/batch_id={batch_id}"

    def stored(table: str, batch_id: int, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(path(table, batch_id)) if batch_id >= 0 else spark.createDataFrame([], schema)

    def process(batch: DataFrame, batch_id: int) -> None:
        known = stored("state", batch_id - 1, STATE).first()
        received = known["last_id"] if known else -1
        upto = last_visible(spark, report_dir)
        sent = batch.where(F.col("request_id").isNotNull()).select("request_id").distinct()
        sent.write.mode("overwrite").parquet(path("sent", batch_id))
        waiting = stored("open", batch_id - 1, OPEN).unionByName(stored("sent", batch_id, OPEN)).distinct()
        incoming = stored("early", batch_id - 1, EARLY)
        if upto > received:
            new = read_batches(spark, report_dir, "replies", REPLY, after=received).where(F.col("batch_id") <= upto)
            incoming = incoming.unionByName(reply_ids(new))
        named = waiting.select(F.col("request_id").alias("_waiting"))
        answered = join_per_key(incoming, named, [("request_id", "_waiting")], "inner").drop("_waiting")
        answered.write.mode("overwrite").parquet(path("answered", batch_id))
        done = stored("answered", batch_id, ANSWERED).select("request_id").distinct()
        waiting.join(done, "request_id", "left_anti").write.mode("overwrite").parquet(path("open", batch_id))
        incoming.join(done, "request_id", "left_anti").write.mode("overwrite").parquet(path("early", batch_id))
        state = spark.createDataFrame([(max(upto, received),)], STATE).coalesce(1)
        state.write.mode("overwrite").parquet(path("state", batch_id))

    return process


def run_reception(messages: DataFrame, report_dir: str, out_dir: str) -> StreamingQuery:
    """Start the reception of replies to ``messages`` (the request stream, without double delivery); it stops when all is done.

    Started again, it goes on with what is open.
    """
    spark = messages.sparkSession
    ended = spark.readStream.schema(f"{STATE}, batch_id int").option("ignoreMissingFiles", "true").parquet(f"{report_dir.rstrip('/')}/state")
    events = messages.select("request_id").unionByName(ended.select(F.lit(None).cast("bigint").alias("request_id")))
    return (
        events.writeStream.foreachBatch(receive_batch(spark, report_dir, out_dir))
        .option("checkpointLocation", f"{out_dir.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_answered(spark: SparkSession, out_dir: str) -> DataFrame:
    """(request_id, report_id) of every reply that was matched with its request."""
    return read_batches(spark, out_dir, "answered", ANSWERED).drop("batch_id")


def read_open(spark: SparkSession, out_dir: str) -> DataFrame:
    """The requests without a reply after the last batch."""
    last = last_visible(spark, out_dir)
    return spark.read.schema(OPEN).parquet(f"{out_dir.rstrip('/')}/open/batch_id={last}") if last >= 0 else spark.createDataFrame([], OPEN)
