"""Versioned tables: touched files only, older versions, the identity mark, retries."""

import os

import pytest
from pyspark.sql import functions as F

from salesops.operators.dml import merge as plain_merge
from salesops.plans.versions import month_delta
from salesops.sources.facts import with_month
from salesops.sources.tables import load
from salesops.sources.versions import VersionedTable
from tests.conftest import rows

MONTH = "o_orderdate_month"


@pytest.fixture
def postings(spark, sf, tmp_path):
    return VersionedTable.create(with_month(load(spark, sf, "orders"), "o_orderdate"), str(tmp_path / "postings"), [MONTH])


def state(table):
    return {f: (os.stat(f).st_mtime_ns, os.stat(f).st_size) for f in table.files()}


def test_merge_of_one_month_leaves_all_other_files(spark, sf, postings):
    before, old_rows = state(postings), rows(postings.read())
    delta = month_delta(spark, sf)
    version, log = postings.merge(delta, ["o_orderkey"], {"o_totalprice": F.col("o_totalprice")})
    after = state(postings)
    gone, new = before.keys() - after.keys(), after.keys() - before.keys()
    assert gone and new and all("1997-01" in f for f in gone | new)
    assert all(after[f] == before[f] for f in before.keys() & after.keys()) and len(before) - len(gone) > 50
    assert version == 1 and rows(postings.read(0)) == old_rows and state(postings).keys() == after.keys()
    expected, expected_log = plain_merge(with_month(load(spark, sf, "orders"), "o_orderdate"), delta, ["o_orderkey"], {"o_totalprice": F.col("o_totalprice")})
    assert rows(postings.read()) == rows(expected)
    assert rows(log) == rows(expected_log)


def test_reading_prunes_months_and_columns(postings):
    df = postings.read().where(F.col(MONTH) == "1997-01-01").select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert MONTH in plan.split("PartitionFilters: [")[1].split("]")[0] and "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_update_and_delete(postings):
    before, n = state(postings), postings.read().count()
    in_month = F.col(MONTH) == "1997-03-01"
    some = postings.read().where(in_month).count()
    postings.update_where(in_month & (F.col("o_orderstatus") == "F"), {"o_orderpriority": F.lit("z")})
    assert postings.read().where("o_orderpriority = 'z'").count() == postings.read(0).where(in_month & (F.col("o_orderstatus") == "F")).count() > 0
    postings.delete_where(in_month)
    assert postings.read().count() == n - some and not any("1997-03" in f for f in postings.files())
    assert {f: s for f, s in before.items() if "1997-03" not in f} == state(postings)
    assert postings.delete_where(F.lit(False)) == 3 and rows(postings.read(3)) == rows(postings.read(2))


def made(spark, tmp_path, n=5, id_col="id"):
    return VersionedTable.create(spark.range(1, n + 1).select("id", F.concat(F.lit("n"), F.col("id")).alias("name")), str(tmp_path / "t"), id_col=id_col)


def test_identities_do_not_come_back(spark, tmp_path):
    table = made(spark, tmp_path)
    table.delete_where(F.col("id") >= 4)
    table.insert(spark.createDataFrame([("b",), ("a",)], "name string"))
    assert rows(table.read().where("id > 3")) == [(6, "a"), (7, "b")]
    table.delete_where(F.lit(True))
    assert table.read().count() == 0
    table.insert(spark.createDataFrame([("c",)], "name string"))
    assert rows(table.read()) == [(8, "c")] and table.latest().last_id == 8
    _, log = table.merge(spark.createDataFrame([("c", 1), ("d", 2)], "name string, x int"), ["name"], {"name": F.col("name")})
    assert rows(table.read()) == [(8, "c"), (9, "d")] and sorted(r.action for r in log.collect()) == ["INSERT", "UPDATE"]


def test_a_retried_insert_is_made_once(spark, tmp_path, monkeypatch):
    table = made(spark, tmp_path)
    more = spark.createDataFrame([("a",), ("b",)], "name string")
    create = type(spark).createDataFrame

    def stopped(self, data, schema=None, **k):
        if isinstance(schema, str) and "last_id" in schema:
            raise RuntimeError("lost before the version was there")
        return create(self, data, schema, **k)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", stopped)
        with pytest.raises(RuntimeError):
            table.insert(more, token="t1")
    assert table.latest().version == 0 and table.read().count() == 5
    assert table.insert(more, token="t1") == 1 == table.insert(more, token="t1")
    assert rows(table.read().where("id > 5")) == [(6, "a"), (7, "b")]
    assert table.insert(more, token="t2") == 2 and table.read().count() == 9


def test_two_writers_of_one_version(spark, tmp_path):
    table = made(spark, tmp_path)
    before = table.latest()
    table.insert(spark.createDataFrame([("a",)], "name string"))
    with pytest.raises(Exception, match="(?i)exists"):
        table._write(before, spark.createDataFrame([(9, "z")], "id bigint, name string"), set(), None)


def test_odd_tables(spark, tmp_path):
    empty = VersionedTable.create(spark.createDataFrame([], "id bigint, name string, tags array<string>"), str(tmp_path / "e"), id_col="id")
    assert empty.read().count() == 0 and empty.files() == [] and empty.latest().last_id == 0
    empty.insert(spark.createDataFrame([(["x"],), (None,)], "tags array<string>"), [F.col("tags")])
    assert sorted((r.id, r.name, r.tags) for r in empty.read().collect()) == [(1, None, None), (2, None, ["x"])]
    _, log = empty.merge(spark.createDataFrame([(None, "q"), ("k", "r")], "name string, other string"), ["name"], {"name": F.col("name")})
    assert empty.read().count() == 4 and log.count() == 2
    with pytest.raises(ValueError, match="duplicate"):
        empty.merge(spark.createDataFrame([("k",), ("k",)], "name string"), ["name"], {"name": F.col("name")})
    with pytest.raises(ValueError, match="no version"):
        empty.read(9)
