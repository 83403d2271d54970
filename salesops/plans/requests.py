"""Report requests made from the event table, run as a stream and as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.sources import sales
from salesops.sources.storage import work_dir
from salesops.sources.tables import load
from salesops.streaming.replies import read_answered, read_open, run_reception
from salesops.streaming.requests import (
    MESSAGE, compact_reports, count_invoices, once, read_rejected, read_replies, read_reports, request_messages, request_stream, run_decoding, run_reports,
)

YEARS_BACK = 28  # events are dated 2024, orders start in 1995
BATCH_FILES = 24  # of messages per batch: a file is decoded by one task


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event: the user's orders from the event's day, for as many days as its property
    says. Errors come from users without a customer record."""
    begin = F.add_months(F.to_date("ts"), -12 * YEARS_BACK)
    days = F.from_json("props", "k int")["k"]
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("event_type") == "error", -1 - F.col("user_id")).otherwise(F.col("user_id")).alias("customer_id"),
        begin.alias("begin_date"),
        F.date_add(begin, days).alias("end_date"),
    )


def _inbox(spark: SparkSession, sf_dir: str, batches: int = 1) -> str:
    """The messages put in an inbox, in BATCH_FILES files for each of a number of batches."""
    inbox = work_dir(spark, "requests")
    request_messages(event_requests(spark, sf_dir), sales.customers(spark, sf_dir), batches * BATCH_FILES).write.parquet(inbox)
    return inbox


def _run(spark: SparkSession, sf_dir: str, as_written: bool, batches: int = 1) -> str:
    """Put the messages in an inbox and run the stream over it to the end, in a number of batches; the output folder."""
    out_dir, inbox = work_dir(spark, "reports"), _inbox(spark, sf_dir, batches)
    n_files = len(spark.read.schema(MESSAGE).parquet(inbox).inputFiles())  # fewer than BATCH_FILES a batch where a table is tiny
    messages = request_stream(spark, inbox, -(-n_files // batches))
    run_reports(messages, _invoices(spark, sf_dir), out_dir, as_written).awaitTermination()
    return out_dir


def report_requests_stream(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """Report rows with their replies; every accepted request has one. ``files``: the batches in which the messages arrive."""
    out_dir = _run(spark, sf_dir, as_written=False, batches=files or 1)
    replies = read_replies(spark, out_dir).select("request_id", F.col("report_id").alias("replied_id"))
    joined = read_reports(spark, out_dir).join(replies, "request_id")
    return joined.select(
        "request_id", "customer_id", "begin_date", "end_date", "counter",
        (F.col("report_id") == F.col("replied_id")).alias("replied"),
    )


def report_requests_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream that arrives in three batches; ids go on from batch to batch."""
    return report_requests_stream(spark, sf_dir, files=3)


def report_requests_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the reports that count something."""
    return read_reports(spark, _run(spark, sf_dir, as_written=True)).select(
        "request_id", "customer_id", "begin_date", "end_date", "counter")


def report_requests_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests without a usable message."""
    out_dir = work_dir(spark, "decoded")
    run_decoding(request_stream(spark, _inbox(spark, sf_dir)), out_dir).awaitTermination()
    return read_rejected(spark, out_dir).select("request_id")


def _invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.orders(spark, sf_dir).select("customer_id", "order_date", "order_ts")


def report_requests_delivered_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports when every message is delivered twice, in different batches: each request is reported once."""
    inbox, out_dir = work_dir(spark, "requests"), work_dir(spark, "reports")
    requests, customers = event_requests(spark, sf_dir), sales.customers(spark, sf_dir)
    for key in (F.col("request_id"), F.xxhash64("request_id")):  # two deliveries, differently dealt into files
        request_messages(requests, customers, 2 * BATCH_FILES, key).write.mode("append").parquet(inbox)
    run_reports(once(request_stream(spark, inbox, BATCH_FILES)), _invoices(spark, sf_dir), out_dir).awaitTermination()
    return read_reports(spark, out_dir).select("request_id", "customer_id", "begin_date", "end_date", "counter")


def report_requests_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports after the job's batches were merged into one, and two more batches came in."""
    inbox, out_dir = work_dir(spark, "requests"), work_dir(spark, "reports")
    messages = request_messages(event_requests(spark, sf_dir), sales.customers(spark, sf_dir), 2 * BATCH_FILES)
    late = F.pmod(F.xxhash64("request_id"), F.lit(2)) == 1
    for part in (~late, late):
        messages.where(part).write.mode("append").parquet(inbox)
        run_reports(request_stream(spark, inbox, BATCH_FILES), _invoices(spark, sf_dir), out_dir).awaitTermination()
        compact_reports(spark, out_dir)
    return read_reports(spark, out_dir).select("request_id", "customer_id", "begin_date", "end_date", "counter")


def _cut_run(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(reports, reception) when the report job has handled the first half of the ids and the other half only was sent."""
    inbox, report_dir, out_dir = work_dir(spark, "requests"), work_dir(spark, "reports"), work_dir(spark, "reception")
    requests = event_requests(spark, sf_dir)
    half = requests.agg(F.floor((F.min("request_id") + F.max("request_id")) / 2)).scalar()
    messages = request_messages(requests, sales.customers(spark, sf_dir), BATCH_FILES).withColumn("_first", F.col("request_id") <= half)
    messages.where("_first").drop("_first").write.parquet(inbox)
    run_reports(request_stream(spark, inbox), _invoices(spark, sf_dir), report_dir).awaitTermination()
    messages.where("NOT _first").drop("_first").write.mode("append").parquet(inbox)
    run_reception(once(request_stream(spark, inbox)), report_dir, out_dir).awaitTermination()
    return report_dir, out_dir


def requests_answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose reply was received, with the count of the report that the reply names."""
    report_dir, out_dir = _cut_run(spark, sf_dir)
    reports = read_reports(spark, report_dir).select("report_id", "customer_id", "counter")
    return read_answered(spark, out_dir).join(reports, "report_id").select("request_id", "customer_id", "counter")


def requests_still_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests without a reply after the cut run: those not handled yet and those whose message was no request."""
    return read_open(spark, _cut_run(spark, sf_dir)[1])


def report_requests_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts alone, without messages, for all requests of known and unknown customers."""
    return count_invoices(event_requests(spark, sf_dir), sales.orders(spark, sf_dir).select("customer_id", "order_date"))
