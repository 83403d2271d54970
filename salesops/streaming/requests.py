"""Report requests: a stream of XML messages becomes report rows and replies.

Each micro-batch writes its own directories, named by the batch id. A batch that is
replayed after a failure overwrites the same directories with the same content, so
requests, reports and replies are each kept exactly once. A batch's state is written last, and readers
take only batches that have one: requests, reports and replies of a batch become visible together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.streaming import StreamingQuery

from salesops.operators.dml import assign_ids
from salesops.operators.ordered import running_sum, with_position
from salesops.operators.predicates import in_period, keep_in
from salesops.operators.skew import join_per_key
from salesops.sources.xml import to_request_xml
from salesops.streaming.batches import STATE, compact, read_batches

MESSAGE = "request_id bigint, body string"
PARAMS = "Params struct<CustomerID:bigint,BeginDate:date,EndDate:date>"
REQUEST = "request_id bigint, body string, customer_id bigint, begin_date date, end_date date, accepted boolean"
REPORT = "report_id bigint, request_id bigint, customer_id bigint, begin_date date, end_date date, counter bigint"
REPLY = "request_id bigint, body string"
TABLES = {"requests": REQUEST, "answers": f"{REPORT}, written boolean", "reports": REPORT, "replies": REPLY}


def request_messages(requests: DataFrame, customers: DataFrame, parts: int | None = None, by: Column | str = "request_id") -> DataFrame:
    """Requests (request_id, customer_id, begin_date, end_date) as messages; an unknown customer has no body.

    With ``parts``, rows are dealt by ``by`` into so many tasks, and so files when written, before their text is made: the few row groups of a
    small file would else make all texts in few tasks, and a file of messages is decoded by one task.
    """
    known = customers.select("customer_id", F.lit(True).alias("_known"))
    named = requests.join(known, "customer_id", "left").select(
        "request_id",
        F.col("customer_id").alias("CustomerID"),
        F.col("begin_date").alias("BeginDate"),
        F.col("end_date").alias("EndDate"),
        "_known",
    )
    if parts:
        named = named.repartition(parts, by)
    full = to_request_xml(named, ["CustomerID", "BeginDate", "EndDate"])
    return full.select("request_id", F.when(F.col("_known"), F.col("body")).alias("body"))


def request_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Messages arriving as Parquet files in a directory."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once(messages: DataFrame, within: str = "7 days") -> DataFrame:
    """Messages of a request stream without those whose request was delivered before, in whatever batch.

    Request ids are kept in the state store for ``within`` of their arrival (the time of the message's file, not of its sender, so that no request is
    too late to be taken); a message delivered again later than that counts as a new request. A message without an id is kept.
    """
    arrived = F.col("_metadata.file_modification_time")
    key = F.coalesce(F.col("request_id").cast("string"), F.uuid())
    timed = messages.select("*", arrived.alias("_arrived"), key.alias("_request")).withWatermark("_arrived", within)
    return timed.dropDuplicatesWithinWatermark(["_request"]).drop("_arrived", "_request")


def compact_reports(spark: SparkSession, out_dir: str) -> int:
    """Merge the finished batches of a report job; the last batch merged."""
    return compact(spark, out_dir, TABLES)


def decode_requests(messages: DataFrame) -> DataFrame:
    """Message bodies to typed columns; ``accepted`` is false for a body that gives no full request."""
    parsed = messages.withColumn("_params", F.from_xml("body", PARAMS, {"mode": "PERMISSIVE"})["Params"])
    typed = parsed.select(
        "request_id",
        "body",
        F.col("_params.CustomerID").alias("customer_id"),
        F.col("_params.BeginDate").alias("begin_date"),
        F.col("_params.EndDate").alias("end_date"),
    )
    whole = F.col("customer_id").isNotNull() & F.col("begin_date").isNotNull() & F.col("end_date").isNotNull()
    return typed.withColumn("accepted", whole)


def count_invoices(requests: DataFrame, invoices: DataFrame) -> DataFrame:
    """Per request, the customer's invoices from begin_date to end_date (inclusive), 0 if none.

    Requests and invoices of a customer are never paired. Invoices become daily counts, the
    requested boundary days are put on the same time line, and a running count per customer
    answers each request as the difference of two days. A customer's time line holds at most
    one row per calendar day, whatever its number of invoices and requests. Invoices of other customers are left out
    before they are counted.
    """
    begin_before = F.date_sub("begin_date", 1)
    own = keep_in(invoices.select("customer_id", "order_date"), requests.select("customer_id"), ["customer_id"])
    daily = own.groupBy("customer_id", F.col("order_date").alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("asked", F.lit(False))
    boundaries = requests.select("customer_id", F.explode(F.array(begin_before, "end_date")).alias("day")).distinct()
    line = (
        daily.unionByName(boundaries.select("customer_id", "day", F.lit(0).alias("n"), F.lit(True).alias("asked")))
        .groupBy("customer_id", "day")
        .agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
        .withColumn("upto", F.sum("n").over(W.partitionBy("customer_id").orderBy("day")))
        .filter("asked")
    )
    until_end = line.select(F.col("customer_id").alias("_end_customer"), F.col("day").alias("_end_day"), F.col("upto").alias("_end"))
    until_begin = line.select(
        F.col("customer_id").alias("_begin_customer"), F.col("day").alias("_begin_day"), F.col("upto").alias("_begin"))
    counted = requests.withColumn("_before", begin_before)
    counted = join_per_key(counted, until_end, [("customer_id", "_end_customer"), ("end_date", "_end_day")], "left")
    counted = join_per_key(counted, until_begin, [("customer_id", "_begin_customer"), ("_before", "_begin_day")], "left")
    counter = F.when(F.col("begin_date") <= F.col("end_date"), F.col("_end") - F.col("_begin")).otherwise(F.lit(0))
    return counted.select("request_id", "customer_id", "begin_date", "end_date", counter.cast("bigint").alias("counter"))


def number_reports(counted: DataFrame, start: int, as_written: bool) -> DataFrame:
    """Counted requests with their report id.

    By default every request gets a report. ``as_written`` leaves out reports that count
    nothing; such a request is answered with the highest id given before it.
    """
    order = [F.col("request_id"), F.col("customer_id"), F.col("begin_date"), F.col("end_date")]
    if not as_written:
        return assign_ids(counted, "report_id", order, start).withColumn("written", F.lit(True))
    placed = with_position(counted, order, "_at").withColumn("written", F.col("counter") > 0)
    given = running_sum(placed, "_at", {"_given": F.col("written").cast("bigint")})
    return given.withColumn("report_id", F.lit(start) + F.col("_given")).drop("_at", "_given")


def _batch_path(out_dir: str, table: str, batch_id: int) -> str:
    return f"{out_dir.rstrip('/')}/{table}/batch_id={batch_id}"


def in_reach(invoices: DataFrame, requests: DataFrame) -> DataFrame:
    """The invoices between the first and the last day that the requests name; a count needs no others.

    With a raw ``order_ts`` the range is put on that column and reaches the scan.
    """
    days = requests.agg(F.min("begin_date").alias("first"), F.max("end_date").alias("last")).first()
    if days["first"] is None or days["first"] > days["last"]:
        return invoices.filter(F.lit(False))
    return in_period(invoices, "order_ts" if "order_ts" in invoices.columns else "order_date", days["first"], days["last"])


def report_batch(invoices: DataFrame, out_dir: str, as_written: bool = False) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch: decode, count, number, reply. ``invoices``: customer_id, order_date and, if it is there, order_ts."""
    spark = invoices.sparkSession

    def store(df: DataFrame, table: str, batch_id: int, schema: str) -> DataFrame:
        path = _batch_path(out_dir, table, batch_id)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(schema).parquet(path)

    def process(messages: DataFrame, batch_id: int) -> None:
        start = 0
        if batch_id > 0:
            start = spark.read.schema(STATE).parquet(_batch_path(out_dir, "state", batch_id - 1)).first()["last_id"]
        requests = store(decode_requests(messages), "requests", batch_id, REQUEST)
        accepted = requests.filter("accepted").drop("body", "accepted")
        numbered = number_reports(count_invoices(accepted, in_reach(invoices, accepted)), start, as_written)
        columns = [c.split()[0] for c in REPORT.split(", ")]
        answers = store(numbered.select(*columns, "written"), "answers", batch_id, TABLES["answers"])
        store(answers.filter("written").select(*columns), "reports", batch_id, REPORT)
        reply = F.concat(F.lit("<ReportID>"), F.col("report_id"), F.lit("</ReportID>"))
        store(answers.select("request_id", reply.alias("body")), "replies", batch_id, REPLY)
        last = answers.agg(F.coalesce(F.max("report_id"), F.lit(start)).cast("bigint").alias("last_id"))
        store(last, "state", batch_id, STATE)

    return process


def decode_batch(spark: SparkSession, out_dir: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch that only takes requests in: nothing is counted."""

    def process(messages: DataFrame, batch_id: int) -> None:
        decode_requests(messages).write.mode("overwrite").parquet(_batch_path(out_dir, "requests", batch_id))
        spark.range(1).select(F.lit(0).cast("bigint").alias("last_id")).write.mode("overwrite").parquet(_batch_path(out_dir, "state", batch_id))

    return process


def run_decoding(messages: DataFrame, out_dir: str) -> StreamingQuery:
    """Start a job that stores the decoded requests of a message stream, for the rejected ones."""
    return (
        messages.writeStream.foreachBatch(decode_batch(messages.sparkSession, out_dir))
        .option("checkpointLocation", f"{out_dir.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def run_reports(messages: DataFrame, invoices: DataFrame, out_dir: str, as_written: bool = False) -> StreamingQuery:
    """Start the job over a message stream; it stops when all available messages are done."""
    return (
        messages.writeStream.foreachBatch(report_batch(invoices, out_dir, as_written))
        .option("checkpointLocation", f"{out_dir.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def replied_id(body: str) -> Column:
    """The report id of a reply message. The plain form, which the job writes, is read as text; any other by XPath, which builds a document per row."""
    plain = F.regexp_extract(body, r"^<ReportID>(\d+)</ReportID>$", 1).try_cast("bigint")
    return F.coalesce(plain, F.xpath_long(body, F.lit("/ReportID")))


def _read(spark: SparkSession, out_dir: str, table: str, schema: str) -> DataFrame:
    return read_batches(spark, out_dir, table, schema)


def read_reports(spark: SparkSession, out_dir: str) -> DataFrame:
    return _read(spark, out_dir, "reports", REPORT)


def read_replies(spark: SparkSession, out_dir: str) -> DataFrame:
    """Replies by request, with the report id taken from the message."""
    replies = _read(spark, out_dir, "replies", REPLY)
    return replies.withColumn("report_id", replied_id("body"))


def read_rejected(spark: SparkSession, out_dir: str) -> DataFrame:
    return _read(spark, out_dir, "requests", REQUEST).filter("not accepted").select("request_id", "body", "batch_id")
