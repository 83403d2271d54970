"""Compaction of finished batches, double delivery, reception of replies."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from salesops.plans import requests as plans
from salesops.streaming import batches
from salesops.streaming.batches import STATE, merged_upto, read_batches, visible_batches
from salesops.streaming.replies import read_answered, read_open, receive_batch, reply_ids, run_reception
from salesops.streaming.requests import REPLY, TABLES, compact_reports, once, read_replies, read_reports, report_batch, request_messages, request_stream, run_reports
from tests.conftest import rows

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def invoices(spark):
    return spark.createDataFrame([(1 + i % 4, DAY + dt.timedelta(i % 9)) for i in range(60)], "customer_id bigint, order_date date")


def messages(spark, ids):
    asked = spark.createDataFrame([(i, 1 + i % 5, DAY, DAY + dt.timedelta(4)) for i in ids], "request_id bigint, customer_id bigint, begin_date date, end_date date")
    return request_messages(asked, spark.range(1, 5).withColumnRenamed("id", "customer_id"))  # customer 5 is not known


def files(folder):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(folder) for name in names)


def test_compaction(spark, invoices, tmp_path):
    out = str(tmp_path / "many")
    one = str(tmp_path / "one")  # sixty requests as one batch, then dealt into twenty
    report_batch(invoices, one)(messages(spark, range(60)), 0)
    for name, schema in {**TABLES, "state": STATE}.items():
        rows_of = spark.read.schema(schema).parquet(f"{one}/{name}/batch_id=0")
        if name == "state":
            last = spark.read.schema(TABLES["reports"]).parquet(f"{one}/reports").groupBy(F.floor(F.col("request_id") / 3).cast("int").alias("batch_id"))
            rows_of = last.agg(F.max("report_id").alias("last_id"))
        else:
            rows_of = rows_of.withColumn("batch_id", F.floor(F.col("request_id") / 3).cast("int"))
        rows_of.coalesce(1).write.partitionBy("batch_id").parquet(f"{out}/{name}")
    process = report_batch(invoices, out)
    before = rows(read_reports(spark, out)), rows(read_replies(spark, out))
    begun = read_reports(spark, out)  # a reader that began before
    n_files = files(f"{out}/reports")
    assert compact_reports(spark, out) == 19 and merged_upto(spark, out) == (0, 19)
    assert (rows(read_reports(spark, out)), rows(read_replies(spark, out))) == before and rows(begun) == before[0]
    assert files(f"{out}/merged/reports") < n_files / 4
    assert compact_reports(spark, out) == 19  # nothing new
    process(messages(spark, [60, 61]), 20)
    later = read_reports(spark, out)
    new = {r.request_id for r in later.collect()} - {r[0] for r in rows(read_reports(spark, out).where("batch_id < 20").select("request_id"))}
    assert new == {60, 61} - {i for i in (60, 61) if 1 + i % 5 == 5}
    expected = rows(later)
    assert compact_reports(spark, out) == 20 and rows(read_reports(spark, out)) == expected == rows(later)
    assert sorted(r.batch_id for r in visible_batches(spark, out).collect()) == [20] and not os.path.exists(f"{out}/reports/batch_id=3")
    process(messages(spark, [70]), 21)  # ids go on after the deleted states
    ids = sorted(r.report_id for r in read_reports(spark, out).collect())
    assert ids == list(range(1, len(ids) + 1))
    compact_reports(spark, out)
    assert not os.path.exists(f"{out}/merged/reports/upto=19")


def test_a_cut_compaction_changes_nothing(spark, invoices, tmp_path, monkeypatch):
    out = str(tmp_path)
    process = report_batch(invoices, out)
    for n in range(3):
        process(messages(spark, [n]), n)
    before = rows(read_reports(spark, out))

    def stopped(*_):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(batches, "last_visible", lambda *_: 2)
        m.setattr(type(spark), "createDataFrame", stopped)
        with pytest.raises(RuntimeError):
            compact_reports(spark, out)
    assert merged_upto(spark, out) == (-1, -1) and rows(read_reports(spark, out)) == before
    assert compact_reports(spark, out) == 2 and rows(read_reports(spark, out)) == before


def test_batches_without_state_are_not_merged(spark, invoices, tmp_path):
    out = str(tmp_path)
    report_batch(invoices, out)(messages(spark, [0, 1]), 0)
    spark.createDataFrame([(9, "<ReportID>9</ReportID>")], REPLY).write.parquet(f"{out}/replies/batch_id=1")
    compact_reports(spark, out)
    assert {r.batch_id for r in read_batches(spark, out, "replies", REPLY).collect()} == {0}


def test_double_delivery(spark, invoices, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (range(6), range(3, 9), range(9)):
        messages(spark, part).coalesce(1).write.mode("append").parquet(inbox)
    run_reports(once(request_stream(spark, inbox, 1)), invoices, out).awaitTermination()
    ids = [r.request_id for r in read_reports(spark, out).collect()]
    assert sorted(ids) == [i for i in range(9) if i % 5 != 4]
    assert read_reports(spark, out).select("batch_id").distinct().count() == 2
    messages(spark, range(5, 12)).coalesce(1).write.mode("append").parquet(inbox)  # a later run still knows what was taken
    run_reports(once(request_stream(spark, inbox, 1)), invoices, out).awaitTermination()
    assert sorted(r.request_id for r in read_reports(spark, out).collect()) == [i for i in range(12) if i % 5 != 4]


def test_reception_goes_on_with_what_is_open(spark, invoices, tmp_path):
    inbox, reports, out = (str(tmp_path / n) for n in ("in", "reports", "out"))
    messages(spark, range(4)).coalesce(1).write.parquet(inbox)
    run_reports(request_stream(spark, inbox), invoices, reports).awaitTermination()
    messages(spark, range(4, 8)).coalesce(1).write.mode("append").parquet(inbox)

    def receive():
        run_reception(once(request_stream(spark, inbox)), reports, out).awaitTermination()
        return {r.request_id for r in read_answered(spark, out).collect()}, {r.request_id for r in read_open(spark, out).collect()}

    assert receive() == ({0, 1, 2, 3}, {4, 5, 6, 7})
    run_reports(request_stream(spark, inbox), invoices, reports).awaitTermination()
    compact_reports(spark, reports)
    assert receive() == ({0, 1, 2, 3, 5, 6, 7}, {4})
    assert receive() == ({0, 1, 2, 3, 5, 6, 7}, {4})  # customer 5 is not known: its request gets no reply
    assert rows(read_answered(spark, out)) == rows(read_replies(spark, reports).select("request_id", "report_id"))


def test_early_replies_and_replayed_batches(spark, invoices, tmp_path):
    reports, out = str(tmp_path / "reports"), str(tmp_path / "out")
    report_batch(invoices, reports)(messages(spark, range(4)), 0)
    receive = receive_batch(spark, reports, out)
    sent = spark.createDataFrame([(1,), (1,), (None,)], "request_id bigint")
    receive(sent, 0)
    for _ in range(2):  # the replay writes the same
        receive(spark.createDataFrame([(0,), (7,)], "request_id bigint"), 1)
        assert rows(read_answered(spark, out)) == [(0, 1), (1, 2)] and rows(read_open(spark, out)) == [(7,)]
    early = spark.read.schema("request_id bigint, report_id bigint").parquet(f"{out}/early/batch_id=1")
    assert rows(early.select("request_id").where(F.col("report_id") > 0)) == [(2,), (3,)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events 0 to 299 of ten customers, two of them unknown, with an order a day for each known one."""
    base = str(tmp_path_factory.mktemp("tables"))
    spark.range(300, numPartitions=1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 10:00:00' AS ts", "id % 10 AS user_id", "'view' AS event_type", "1.0D AS value",
        "concat('{\"k\": ', id % 7, '}') AS props").write.parquet(f"{base}/events.parquet")
    spark.range(8).selectExpr("id AS c_custkey", "'n' AS c_name", "1 AS c_nationkey", "0.0D AS c_acctbal", "'s' AS c_mktsegment").write.parquet(f"{base}/customer.parquet")
    spark.range(80).selectExpr(
        "id AS o_orderkey", "id % 8 AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice",
        "cast(date_add(date'1996-01-01', int(id div 8)) AS timestamp_ntz) AS o_orderdate", "'5' AS o_orderpriority").write.parquet(f"{base}/orders.parquet")
    return base


COUNTED = sorted(((i, i % 7 + 1) for i in range(300) if i % 10 < 8), key=repr)


def test_three_batches_of_many_files(spark, tables):
    assert files(plans._inbox(spark, tables, 3)) > 2 * plans.BATCH_FILES  # decoded by as many tasks, not by one a batch
    out = plans._run(spark, tables, as_written=False, batches=3)
    assert {r.batch_id for r in read_reports(spark, out).select("batch_id").distinct().collect()} == {0, 1, 2}
    assert rows(plans.report_requests_batches(spark, tables).where("replied").select("request_id", "counter")) == COUNTED


def inboxes(monkeypatch):
    """The folders from which the reports read their requests, from now on."""
    seen, plain = [], plans.request_stream
    monkeypatch.setattr(plans, "request_stream", lambda spark, path, *rest: (seen.append(path), plain(spark, path, *rest))[1])
    return seen


def test_compacted_batches_of_many_files(spark, tables, monkeypatch):
    seen = inboxes(monkeypatch)
    found = plans.report_requests_compacted(spark, tables)
    assert files(seen[0]) > 3 * plans.BATCH_FILES  # four batches
    assert rows(found.select("request_id", "counter")) == COUNTED


def test_open_requests_of_many_files(spark, tables, monkeypatch):
    seen = inboxes(monkeypatch)
    found = plans.requests_still_open(spark, tables)
    assert files(seen[0]) > plans.BATCH_FILES  # two parts
    assert rows(found) == sorted(((i,) for i in range(300) if i > 149 or i % 10 > 7), key=repr)


def test_reply_ids_of_any_message(spark):
    bodies = ["<ReportID>12</ReportID>", "<ReportID>9007199254740993</ReportID>", "<ReportID> 5 </ReportID>", "<?xml version='1.0'?><ReportID a='1'>7</ReportID>",
              "<ReportID>-3</ReportID>", "<Other>4</Other>", "<ReportID>x</ReportID>", "<ReportID>1</ReportID>\n", None]
    got = {r.request_id: r.report_id for r in reply_ids(spark.createDataFrame(list(enumerate(bodies)), "request_id bigint, body string")).collect()}
    assert [got[i] for i in range(len(bodies))] == [12, 9007199254740993, 5, 7, -3, 0, 0, 1, None]  # XPath alone gives ...992, a double
