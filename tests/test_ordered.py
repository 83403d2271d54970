"""Distributed whole-table windows against Spark's own one-task windows."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesops.operators.ordered import Neighbour, dense_ranks, running_sum, tile, with_dense_rank, with_position
from salesops.operators.aggregates import ordered_text, ordered_text_parts
from salesops.operators.toplimit import deep_page, last_key, page, page_after
from salesops.plans import selections
from salesops.sources import sales
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    """A third of all rows share one value; some values are NULL."""
    pick = random.Random(5)
    values = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"n{pick.randint(0, 60):02d}"), pick.randint(1, 9)) for i in range(600)]
    pick.shuffle(values)
    return spark.createDataFrame(values, "id bigint, name string, v bigint").repartition(5).cache()


def test_position_and_total(data):
    order = [F.col("name"), F.col("id")]
    w = W.orderBy(*order)
    mine = with_position(data, order, "pos", "total").select("id", "pos", "total")
    plain = data.select("id", F.row_number().over(w).cast("bigint"), F.count("*").over(W.partitionBy()))
    assert rows(mine) == rows(plain)


def test_position_descending(data):
    order = [F.col("v").desc(), F.col("id").desc()]
    mine = with_position(data, order, "pos").select("id", "pos")
    assert rows(mine) == rows(data.select("id", F.row_number().over(W.orderBy(*order)).cast("bigint")))


@pytest.mark.parametrize("offset", [1, -1, 3, -7])
def test_neighbours(data, offset):
    order = [F.col("name"), F.col("id")]
    w = W.orderBy(*order)
    mine = with_position(data, order, "pos", neighbours=[Neighbour("name", offset, "n", "none"), Neighbour("id", -2, "i")])
    far = F.lead("name", offset, "none") if offset > 0 else F.lag("name", -offset, "none")
    plain = data.select("id", far.over(w), F.lag("id", 2).over(w))
    assert rows(mine.select("id", "n", "i")) == rows(plain)


def test_neighbours_reach_across_short_partitions(spark):
    """Five rows in up to four range partitions: a neighbour may lie several partitions away."""
    few = spark.createDataFrame([(i, f"x{i}") for i in range(5)], "id bigint, name string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mine = with_position(few, [F.col("id")], "pos", neighbours=[Neighbour("name", 3, "a", "-"), Neighbour("name", -3, "b", "-")])
        got = rows(mine.select("id", "a", "b"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == [(0, "x3", "-"), (1, "x4", "-"), (2, "-", "-"), (3, "-", "x0"), (4, "-", "x1")]


def test_position_of_nothing(spark):
    none = spark.createDataFrame([], "id bigint, name string")
    assert with_position(none, [F.col("id")], "pos", "total", [Neighbour("name", 1, "n")]).collect() == []


@pytest.mark.parametrize("tiles", [1, 7, 30, 599, 600, 1000])
def test_tiles(data, tiles):
    order = [F.col("v"), F.col("id")]
    placed = with_position(data, order, "pos", "total")
    mine = placed.select("id", tile(F.col("pos"), F.col("total"), tiles))
    assert rows(mine) == rows(data.select("id", F.ntile(tiles).over(W.orderBy(*order))))


def test_dense_rank_in_key(data):
    mine = with_dense_rank(data, ["v"], "name", "r").select("id", "r")
    plain = data.select("id", F.dense_rank().over(W.partitionBy("v").orderBy("name")))
    assert rows(mine) == rows(plain)
    assert dense_ranks(data, ["v"], "name", "r").count() == data.select("v", "name").distinct().count()


def test_running_sum_has_range_frame(data):
    mine = running_sum(data, "name", {"n": F.lit(1), "s": F.col("v")}).select("id", "n", "s")
    w = W.orderBy("name")
    assert rows(mine) == rows(data.select("id", F.count("*").over(w), F.sum("v").over(w)))


def test_deep_page_equals_shallow_page(data):
    order = [F.col("name"), F.col("id")]
    shallow = rows(page(data, order, 100, 50, 3))
    assert rows(deep_page(data, order, 100, 50, 3)) == shallow
    assert len(shallow) == 50


def test_nothing_runs_in_one_task(data):
    """No window without a partition key over the rows themselves."""
    df = with_position(data, [F.col("id")], "pos", neighbours=[Neighbour("v", 1, "n")])
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    gathered = [plan[i + 1] for i, line in enumerate(plan) if "Exchange SinglePartition" in line]
    assert gathered and all("HashAggregate(keys=[_bucket" in line for line in gathered)


@pytest.mark.parametrize("down", [False, True])
def test_pages_by_last_key_give_the_whole_order_once(data, down):
    order = {"name": down, "v": not down, "id": down}
    sort = [F.col(c).desc() if d else F.col(c).asc() for c, d in order.items()]
    walked, key = [], None
    while True:
        seen = page_after(data, order, 50, key)
        got = [tuple(r) for r in seen.collect()]
        if not got:
            break
        walked += got
        key = last_key(seen, order)
        assert key == dict(zip(["id", "name", "v"], got[-1]))
    assert walked == [tuple(r) for r in data.orderBy(*sort).collect()]
    assert last_key(data.limit(0), order) is None


def test_next_page_is_a_pushed_filter_and_a_top_k(spark, sf):
    rows_ = sales.orders(spark, sf).select("order_id", "order_ts")
    order = {"order_ts": False, "order_id": False}
    key = last_key(page_after(rows_, order, 700), order)
    plan = page_after(rows_, order, 20, key)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan and "Exchange" not in plan
    assert selections.orders_page_walk(spark, sf, 100, 10**3).count() == 0


def test_text_of_a_hot_key_in_parts(spark):
    hot = spark.range(30_000).select(F.lit("hot").alias("k"), F.format_string("%06d", F.col("id") % 20_000).alias("w"))
    rest = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), (None, "z"), ("n", None), ("n", None)], "k string, w string")
    got = ordered_text_parts(hot.union(rest), ["k"], "w", "-", 500).collect()
    texts = {}
    for r in sorted(got, key=lambda r: (str(r.k), r.part)):
        assert r.w_list is None or r.w_list.count("-") < 500
        texts.setdefault(r.k, []).append(r.w_list)
    assert len(texts["hot"]) == 40 and texts["a"] == ["x-y"] and texts["n"] == [None] and texts[None] == ["z"]
    whole = {r.k: r.w_list for r in ordered_text(hot.union(rest), ["k"], "w", "-").collect()}
    assert {k: None if t == [None] else "-".join(t) for k, t in texts.items()} == whole
    assert ordered_text_parts(rest.limit(0), ["k"], "w").count() == 0
