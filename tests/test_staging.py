"""Staging load: periods, resolution, reconciliation, checks."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesops.functions.dates import month_bounds, resolve_period
from salesops.operators.quality import check_fields, check_foreign_key, check_primary_key
from salesops.operators.staging import active, reconcile, resolve_ids, staging_buffer
from salesops.sources import finance
from tests.conftest import rows


@pytest.mark.parametrize(
    "mode, today, expected",
    [
        ("current period", dt.date(2026, 1, 31), (2026, 1)),
        ("previous period", dt.date(2026, 1, 31), (2025, 12)),
        ("previous period", dt.date(2026, 3, 31), (2026, 2)),
    ],
)
def test_period(mode, today, expected):
    assert resolve_period(mode, today) == expected


def test_unknown_period_mode():
    with pytest.raises(ValueError):
        resolve_period("next period")


def test_month_bounds():
    assert month_bounds(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert month_bounds(2023, 12) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))


def stage(spark, data):
    full = [(d, t, "acc", "agr", "client", "ground", "62", None) for d, t in data]
    return spark.createDataFrame(full, finance.SCHEMAS["buf_fct_carry"])


def test_buffer_keeps_the_month_and_collapses_copies(spark):
    data = [
        (dt.datetime(2026, 2, 28, 23, 59, 59), 1.0), (dt.datetime(2026, 2, 28, 23, 59, 59), 1.0),
        (dt.datetime(2026, 2, 1), 2.0), (dt.datetime(2026, 1, 31, 23, 0), 3.0), (dt.datetime(2026, 3, 1), 4.0),
        (dt.datetime(2025, 2, 5), 5.0), (None, 6.0),
    ]
    got = staging_buffer(stage(spark, data), 2026, 2).select("carry_date", "turnover_sum")
    assert rows(got) == [(dt.date(2026, 2, 1), 2.0), (dt.date(2026, 2, 28), 1.0)]


def test_unknown_names_resolve_to_minus_one(spark):
    buffer = spark.createDataFrame(
        [("c1", "g1", "a1"), ("c2", None, "zz"), ("c1", "g1", "a1")], "client_name string, agreement_name string, account_name string")
    clients = spark.createDataFrame([(8, "c1"), (5, "c1"), (6, None)], "id_client bigint, client_name string")
    agreements = spark.createDataFrame([(1, "g1"), (2, None)], "id_agreement bigint, agreement_name string")
    accounts = spark.createDataFrame([(9, "a1")], "id_account bigint, account_name string")
    got = resolve_ids(buffer, clients, agreements, accounts).select("id_client", "id_agreement", "id_account")
    assert rows(got) == [(-1, -1, -1), (5, 1, 9), (5, 1, 9)]


def test_active_rows(spark):
    dim = spark.createDataFrame(
        [(1, dt.date(2099, 1, 1), False), (2, dt.date(2020, 1, 1), False), (3, dt.date(2099, 1, 1), True), (4, dt.date(2099, 1, 1), None)],
        "id int, valid_to date, is_del boolean")
    assert rows(active(dim, F.lit(dt.date(2021, 1, 1))).select("id")) == [(1,), (4,)]


KEYS = ["account", "extra"]
SCHEMA = "account string, extra string, vl decimal(28,12)"
postings = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["x", None]), st.integers(-3, 3).map(lambda n: Decimal(n) / 4)), max_size=8)


def sums(df):
    net = df.groupBy(*KEYS).agg(F.sum("vl").alias("s")).filter("s <> 0")
    return rows(net)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(new=postings, old=postings)
def test_reconciliation_reaches_the_buffer_and_then_rests(spark, new, old):
    buffer, stored = spark.createDataFrame(new, SCHEMA), spark.createDataFrame(old, SCHEMA)
    emitted = reconcile(buffer, stored, KEYS)
    after = stored.unionByName(emitted.select("account", "extra", "vl"))
    assert sums(after) == sums(buffer)
    assert reconcile(buffer, after, KEYS).count() == 0


def test_reconciliation_rules(spark):
    one = Decimal(1)
    buffer = spark.createDataFrame([("same", None, one), ("changed", "x", one), ("new", "x", one)], SCHEMA)
    stored = spark.createDataFrame([("same", None, one), ("changed", "x", 2 * one), ("gone", None, one)], SCHEMA)
    got = reconcile(buffer, stored, KEYS).select("account", "action", F.col("vl").cast("int"), "is_del")
    assert rows(got) == sorted([
        ("changed", "reversal", -2, False), ("changed", "insert", 1, False), ("new", "insert", 1, False), ("gone", "reversal", -1, False),
    ], key=repr)


def test_checks(spark):
    table = spark.createDataFrame([(1, "ok"), (2, None), (3, "too long"), (3, "ok"), (None, "ok")], "id int, name string")
    assert rows(check_fields(table, ["id"], ["name"], {"name": 5})) == [(2, "name", "not null"), (3, "name", "length <= 5")]
    parent = spark.createDataFrame([(1,), (2,)], "pid int")
    assert rows(check_foreign_key(table, parent, {"id": "pid"}).select("id", "name")) == [(3, "ok"), (3, "too long")]
    assert rows(check_primary_key(table, ["id"])) == [(3, 2)]


def test_seeded_chart(spark):
    chart = finance.seed_bal2(spark)
    assert [r.name for r in chart.orderBy("id_bal2").collect()] == ["*", "60", "62", "66", "67", "68", "79"]
    assert check_primary_key(chart, ["id_bal2"]).count() == 0
    assert check_fields(chart, ["id_bal2"], ["name", "description"], finance.MAX_LENGTHS["dic_bal2"]).count() == 0
    assert check_foreign_key(chart, finance.seed_bal2_version(spark), {"id_bal2_version": "id_bal2_version"}).count() == 0
    for name in finance.SCHEMAS:
        assert finance.empty(spark, name).count() == 0
