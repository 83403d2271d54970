"""The request stream: batches, replies, replays, rejects; counts against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesops.sources import sales
from salesops.streaming.requests import (
    count_invoices, decode_requests, in_reach, read_rejected, read_replies, read_reports, report_batch, request_messages, request_stream, run_reports,
)
from tests.conftest import rows

D = dt.date


@pytest.fixture(scope="module")
def invoices(spark):
    """Customer 1 holds a third of the invoices."""
    pick = random.Random(3)
    data = [(1 if i % 3 == 0 else pick.randint(2, 9), D(2020, 1, 1) + dt.timedelta(pick.randint(0, 60))) for i in range(300)]
    return spark.createDataFrame(data, "customer_id bigint, order_date date").cache()


@pytest.fixture(scope="module")
def requests(spark):
    pick = random.Random(4)
    data = []
    for i in range(60):
        begin = D(2019, 12, 25) + dt.timedelta(pick.randint(0, 70))
        data.append((i, 1 if i % 3 == 0 else pick.randint(1, 12), begin, begin + dt.timedelta(pick.randint(-3, 40))))
    return spark.createDataFrame(data, "request_id bigint, customer_id bigint, begin_date date, end_date date").cache()


def brute(requests, invoices):
    sold = [tuple(r) for r in invoices.collect()]
    return sorted(
        (*tuple(r), sum(c == r.customer_id and r.begin_date <= d <= r.end_date for c, d in sold)) for r in requests.collect())


def test_counts_equal_brute_force(requests, invoices):
    assert rows(count_invoices(requests, invoices)) == sorted(brute(requests, invoices), key=repr)


def stream(spark, requests, invoices, tmp_path, files, as_written=False):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    known = spark.range(1, 11).withColumnRenamed("id", "customer_id")
    request_messages(requests, known).repartition(files).write.parquet(inbox)
    run_reports(request_stream(spark, inbox, files_per_batch=1), invoices, out, as_written).awaitTermination()
    return out


def test_stream_in_several_batches(spark, requests, invoices, tmp_path):
    out = stream(spark, requests, invoices, tmp_path, files=3)
    reports = read_reports(spark, out)
    expected = [r for r in brute(requests, invoices) if r[1] <= 10]
    assert rows(reports.select("request_id", "customer_id", "begin_date", "end_date", "counter")) == sorted(expected, key=repr)
    assert sorted(r.report_id for r in reports.collect()) == list(range(1, len(expected) + 1))
    spans = reports.groupBy("batch_id").agg(F.min("report_id"), F.max("report_id")).orderBy("batch_id").collect()
    assert len(spans) == 3 and all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
    assert rows(read_replies(spark, out).select("request_id", "report_id")) == rows(reports.select("request_id", "report_id"))
    rejected = {r.request_id for r in read_rejected(spark, out).collect()}
    assert rejected == {r.request_id for r in requests.collect() if r.customer_id > 10}


def test_as_written_answers_with_the_last_report(spark, requests, invoices, tmp_path):
    out = stream(spark, requests, invoices, tmp_path, files=1, as_written=True)
    reports = {r.request_id: r.report_id for r in read_reports(spark, out).collect()}
    counted = {r[0]: r[4] for r in brute(requests, invoices) if r[1] <= 10}
    assert set(reports) == {i for i, n in counted.items() if n > 0}
    last, expected = 0, {}
    for i in sorted(counted):
        last = reports.get(i, last)
        expected[i] = last
    assert {r.request_id: r.report_id for r in read_replies(spark, out).collect()} == expected


def test_replayed_batch_changes_nothing(spark, requests, invoices, tmp_path):
    known = spark.range(1, 11).withColumnRenamed("id", "customer_id")
    messages = request_messages(requests, known)
    process = report_batch(invoices, str(tmp_path))
    process(messages.filter("request_id < 30"), 0)
    process(messages.filter("request_id >= 30"), 1)
    before = rows(read_reports(spark, str(tmp_path))), rows(read_replies(spark, str(tmp_path)))
    process(messages.filter("request_id >= 30"), 1)
    assert (rows(read_reports(spark, str(tmp_path))), rows(read_replies(spark, str(tmp_path)))) == before


def test_an_unfinished_batch_is_not_visible(spark, requests, invoices, tmp_path, monkeypatch):
    from salesops.streaming import requests as job

    messages = request_messages(requests, spark.range(1, 11).withColumnRenamed("id", "customer_id"))
    process = report_batch(invoices, str(tmp_path))
    process(messages.filter("request_id < 30"), 0)
    before = rows(read_reports(spark, str(tmp_path))), rows(read_replies(spark, str(tmp_path)))
    path = job._batch_path

    def stopped(out_dir, table, batch_id):
        if table == "state" and batch_id == 1:
            raise RuntimeError("stopped before the state")
        return path(out_dir, table, batch_id)

    monkeypatch.setattr(job, "_batch_path", stopped)
    process = report_batch(invoices, str(tmp_path))
    with pytest.raises(RuntimeError):
        process(messages.filter("request_id >= 30").withColumn("body", F.col("body")), 1)
    assert (tmp_path / "replies" / "batch_id=1").exists()
    assert (rows(read_reports(spark, str(tmp_path))), rows(read_replies(spark, str(tmp_path)))) == before


def test_counts_read_the_asked_days_only(spark, sf):
    orders = sales.orders(spark, sf).select("customer_id", "order_date", "order_ts")
    asked = spark.createDataFrame([(1, 5, D(1996, 3, 1), D(1996, 4, 30))], "request_id bigint, customer_id bigint, begin_date date, end_date date")
    plan = count_invoices(asked, in_reach(orders, asked))._jdf.queryExecution().toString()
    pushed = [line for line in plan.split("\n") if "PushedFilters" in line and "o_orderdate" in line]
    assert pushed and all("GreaterThanOrEqual(o_orderdate" in line and "LessThan(o_orderdate" in line for line in pushed)


def test_malformed_messages_are_not_accepted(spark):
    bodies = ["<RequestMessage><Params><CustomerID>124</CustomerID><BeginDate>2013-01-07</BeginDate><EndDate>2016-05-26</EndDate></Params></RequestMessage>",
              "<RequestMessage><Params><CustomerID>x</CustomerID></Params></RequestMessage>", "<Request", None]
    got = decode_requests(spark.createDataFrame(list(enumerate(bodies)), "request_id bigint, body string")).drop("body")
    assert rows(got)[0] == (0, 124, D(2013, 1, 7), D(2016, 5, 26), True)
    assert [r.accepted for r in got.orderBy("request_id").collect()] == [True, False, False, False]
