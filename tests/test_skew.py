"""One key with a third of the rows: same results, and the work is split."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesops.operators.joins import apply_rows, top_n_per_outer, without_related, without_related_full
from salesops.operators.predicates import keep_in
from salesops.operators.windows import latest_rows, top_n_per_group, with_group_total, within_top_values
from tests.conftest import rows

SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def splitting(spark):
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 rows; key 7 holds a third, and half of those on its last day."""
    base = spark.range(0, 60000, 1, 12).withColumn("key", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997))
    day = F.when((F.col("key") == 7) & (F.col("id") % 2 == 0), 999).otherwise(F.pmod(F.hash("id"), F.lit(300)))
    return base.withColumn("day", day).withColumn("text", F.sha2(F.col("id").cast("string"), 256)).cache()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_total_is_split(splitting, hot):
    mine = with_group_total(hot, ["key"], [F.count(F.lit(1)).alias("n"), F.max("day").alias("last")])
    assert "SortMergeJoin(skew=true)" in final_plan(mine)
    w = W.partitionBy("key")
    assert rows(mine.select("id", "n", "last")) == rows(hot.select("id", F.count("*").over(w), F.max("day").over(w)))


def test_latest_rows_are_split(splitting, hot):
    mine = latest_rows(hot, ["key"], "day")
    assert "SortMergeJoin(skew=true)" in final_plan(mine)
    ranked = hot.withColumn("r", F.dense_rank().over(W.partitionBy("key").orderBy(F.col("day").desc()))).filter("r = 1")
    assert rows(mine.select("id")) == rows(ranked.select("id"))


def test_key_set_is_split(splitting, hot, spark):
    wanted = hot.filter("key % 2 = 1").select("key")
    mine = keep_in(hot, wanted, ["key"])
    assert "SortMergeJoin(skew=true)" in final_plan(mine)
    assert rows(mine.select("id")) == rows(hot.filter("key % 2 = 1").select("id"))


def test_top_values(hot):
    mine = within_top_values(hot, ["key"], "day", 3)
    ranked = hot.withColumn("r", F.dense_rank().over(W.partitionBy("key").orderBy(F.col("day").desc()))).filter("r <= 3")
    assert rows(mine.select("id")) == rows(ranked.select("id"))


def test_top_n_is_cut_before_the_shuffle(hot):
    mine = top_n_per_group(hot, ["key"], [F.col("day").desc(), F.col("id")], 2)
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert mine.filter("key = 7").count() == 2


def test_top_n_per_outer_row(hot, spark):
    outer = spark.createDataFrame([(7,), (7,), (5000,)], "key bigint")
    mine = top_n_per_outer(outer, hot, ["key"], [F.col("day").desc(), F.col("id")], 3)
    assert mine.count() == 6


def test_anti_join_reads_each_key_once(hot, spark):
    left = spark.range(1000).withColumnRenamed("id", "key")
    mine = without_related(left, hot, ["key"])
    known = {r[0] for r in hot.select("key").distinct().collect()}
    assert {r[0] for r in mine.collect()} == set(range(1000)) - known


def test_anti_joins_and_outer_apply_are_split(splitting, hot, spark):
    some = hot.filter("key % 2 = 1").select("key", F.col("day").alias("other"))
    small = spark.range(20).select(F.col("id").alias("key"))
    expected = rows(hot.join(some.select("key").distinct(), "key", "left_anti").select("id").distinct())
    for form in (without_related, without_related_full):
        mine = form(hot, some.unionByName(spark.createDataFrame([(None, 1)], "key bigint, other int")), ["key"])
        assert "SortMergeJoin(skew=true)" in final_plan(mine)
        assert rows(mine.select("id")) == expected
    outer = spark.range(990, 1010).select(F.col("id").alias("key")).union(small)
    mine = apply_rows(outer, hot.select("key", "id", "text"), ["key"], keep_unmatched=True)
    assert "SortMergeJoin(skew=true)" in final_plan(mine)
    assert rows(mine.select("key", "id")) == rows(outer.join(hot, "key", "left").select("key", "id"))
