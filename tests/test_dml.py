"""Insert, update, delete, merge."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesops.operators.dml import (
    assign_ids, delete_where, extend_dictionary, insert_rows, merge, seed_rows, update_all, update_from, update_where, upsert, upsert_log,
)
from salesops.sources.storage import write_version
from tests.conftest import rows

TABLE = "id bigint, name string, v int, note string"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 10, "x"), (2, "b", 20, None), (5, None, 50, "n")], TABLE)


def test_insert_fills_ids_and_defaults(spark, table):
    new = spark.createDataFrame([("c", 1), ("d", None)], "name string, v int")
    got = insert_rows(table, new, "id", [F.col("name")], {"note": F.lit("new"), "v": F.lit(7)})
    assert rows(got)[-2:] == [(6, "c", 1, "new"), (7, "d", 7, "new")]
    assert got.count() == 5


def test_insert_into_empty_table(spark, table):
    got = insert_rows(table.filter("false"), spark.createDataFrame([("z",)], "name string"), "id")
    assert rows(got) == [(1, "z", None, None)]


def test_ids_follow_the_order(spark):
    got = assign_ids(spark.range(50).withColumnRenamed("id", "k"), "id", [F.col("k").desc()], 100)
    assert rows(got.select("k", "id")) == sorted(((49 - i, 101 + i) for i in range(50)), key=repr)


def test_seed_rows_leave_other_columns_null(table):
    assert rows(seed_rows(table, [{"name": "s"}])) == [(None, "s", None, None)]


def test_update_and_delete_treat_unknown_as_false(table):
    got = update_where(table, F.col("name") == "a", {"v": F.col("id") + 100, "id": F.col("v").cast("bigint")})
    assert rows(got) == sorted([(10, "a", 101, "x"), (2, "b", 20, None), (5, None, 50, "n")], key=repr)
    assert rows(delete_where(table, F.col("name") == "a").select("id")) == [(2,), (5,)]
    assert rows(delete_where(table, F.col("name") != "a").select("id")) == [(1,), (5,)]
    assert {r.v for r in update_all(table, {"v": F.lit(0)}).collect()} == {0}


def test_update_from_join(spark, table):
    source = spark.createDataFrame([("a", 11), ("zz", 9)], "name string, w int")
    assert rows(update_from(table, source, ["name"], {"v": "w"}).select("id", "v")) == [(1, 11), (2, 20), (5, 50)]


def test_merge_updates_inserts_and_logs(spark, table):
    source = spark.createDataFrame([("a", 99), ("q", 1), (None, 2), (None, 2)], "name string, v int")
    new, log = merge(table, source, ["name"], {"v": F.col("v")}, id_col="id", insert_defaults={"note": F.lit("d")})
    assert rows(new.filter("id <= 5")) == sorted([(1, "a", 99, "x"), (2, "b", 20, None), (5, None, 50, "n")], key=repr)
    assert rows(new.filter("id > 5").select("name", "v", "note")) == [("q", 1, "d"), (None, 2, "d"), (None, 2, "d")]
    assert sorted(r.id for r in new.collect()) == [1, 2, 5, 6, 7, 8]
    actions = [(r.action, r.old.v if r.old else None, r.new.v) for r in log.collect()]
    assert sorted(actions, key=repr) == sorted([("UPDATE", 10, 99), ("INSERT", None, 1), ("INSERT", None, 2), ("INSERT", None, 2)], key=repr)


def test_merge_refuses_double_keys(spark, table):
    source = spark.createDataFrame([("a", 1), ("a", 2)], "name string, v int")
    with pytest.raises(ValueError, match="duplicate source keys"):
        merge(table, source, ["name"], {"v": F.col("v")})


pairs = st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=pairs, new=pairs)
def test_merge_is_idempotent(spark, old, new):
    schema = "name string, v int"
    target = spark.createDataFrame(list(old.items()), schema)
    source = spark.createDataFrame(list(new.items()), schema)
    once = upsert(target, source, ["name"], {"v": F.col("v")})
    assert dict(rows(once)) == {**old, **new}
    assert rows(upsert(once, source, ["name"], {"v": F.col("v")})) == rows(once)
    assert upsert_log(once, source, ["name"], {"v": F.col("v")}).filter("action = 'INSERT'").count() == 0


def test_dictionary_takes_each_new_name_once(spark):
    dim = spark.createDataFrame([(3, "known", dt.date(2020, 1, 1))], "id bigint, name string, created date")
    src = spark.createDataFrame([("known",), ("x",), ("x",), ("",), (None,), ("y",)], "name string")
    full, added = extend_dictionary(dim, src, "name", "id", defaults={"created": F.lit(dt.date(2021, 1, 1))})
    assert rows(added) == [(4, "x", dt.date(2021, 1, 1)), (5, "y", dt.date(2021, 1, 1))]
    assert full.count() == 3
    assert extend_dictionary(full, src, "name", "id")[1].count() == 0


def test_versions_lie_side_by_side(spark, table, tmp_path):
    first = write_version(table, str(tmp_path / "t"), 1)
    second = write_version(delete_where(first, F.col("id") == 1), str(tmp_path / "t"), 2)
    assert first.count() == 3 and second.count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_version(table, str(tmp_path / "t"), 2)
