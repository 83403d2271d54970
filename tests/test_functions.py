"""Column functions and predicates on literal edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from salesops.functions import dates, texts
from salesops.operators.aggregates import collapse_duplicates, ordered_text, range_profile, weighted_mean, with_empty_months
from salesops.operators.predicates import in_month, in_period, in_trimmed, like_any, not_in
from salesops.operators.reshape import unpivot_columns
from tests.conftest import rows


def one(spark, col):
    return spark.range(1).select(col).first()[0]


def test_thirds_and_months(spark):
    for month, third in [(1, 1), (4, 1), (5, 2), (8, 2), (9, 3), (12, 3)]:
        day = F.lit(dt.date(2020, month, 5))
        assert one(spark, dates.third_of_year(day)) == third
    assert one(spark, dates.month_name(F.lit(dt.date(2020, 5, 1)))) == "Май"
    assert one(spark, dates.month_name(F.lit(dt.date(2020, 5, 1)), "en")) == "May"
    assert one(spark, dates.month_name(F.lit(None).cast("date"))) is None


def test_date_texts(spark):
    day = F.lit(dt.date(2024, 2, 3))
    assert one(spark, dates.date_text(day)) == "03.02.2024"
    assert one(spark, dates.iso_text(day)) == "2024-02-03"
    assert one(spark, dates.parse_date(F.lit("28.12.2026"))) == dt.date(2026, 12, 28)
    assert one(spark, dates.parse_date(F.lit("32.12.2026"))) is None
    assert one(spark, dates.month_end(day)) == dt.date(2024, 2, 29)
    assert one(spark, dates.days_between(day, F.lit(dt.date(2024, 3, 1)))) == 27
    assert one(spark, dates.first_of_month(F.lit(2024), F.lit(7))) == dt.date(2024, 7, 1)


def test_texts(spark):
    assert one(spark, texts.between_parentheses(F.lit("Shop (Lima, PE) (2)"))) == "Lima, PE"
    assert one(spark, texts.between_parentheses(F.lit("none"))) == ""
    assert one(spark, texts.concat_text(F.lit("a"), F.lit(None), F.lit(3))) == "a3"
    assert texts.quoted_name("a`b") == "`a``b`"


def test_like_any(spark):
    df = spark.createDataFrame([("Animal",), ("an urgent",), ("URGENT",), ("x",), (None,)], "s string")
    assert rows(df.filter(like_any("s", ["%urgent%", "Animal%"]))) == [("Animal",), ("an urgent",)]
    assert df.filter(like_any("s", ["%urgent%"], ignore_case=True)).count() == 2
    assert df.filter(in_trimmed(F.concat(F.lit(" "), "s", F.lit(" ")), ["x"])).count() == 1


def test_period_includes_its_last_day(spark):
    times = [dt.datetime(2020, 1, 31, 23, 59, 59, 999999), dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1), dt.datetime(2019, 12, 31, 23), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert in_month(df, "t", 2020, 1).count() == 2
    assert in_period(df.select(F.to_date("t").alias("t")), "t", dt.date(2020, 1, 31), dt.date(2020, 2, 1)).count() == 2


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")

    def check(ids):
        right = spark.createDataFrame([(i,) for i in ids], "k int")
        df.createOrReplaceTempView("l")
        right.createOrReplaceTempView("r")
        assert rows(not_in(df, right, "k")) == rows(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)"))

    check([2, 2])
    check([2, None])
    check([])
    check([None])


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 10, 2), ("a", 20, 8), ("b", 5, 0)], "k string, amount int, n int")
    assert rows(df.groupBy("k").agg(weighted_mean(F.col("amount"), F.col("n")))) == [("a", 3.0), ("b", None)]
    words = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, w string")
    assert rows(ordered_text(words, ["k"], "w", "-")) == [(1, "a-b"), (2, None)]
    assert collapse_duplicates(words).count() == 3
    spans = spark.createDataFrame([(1, dt.date(2020, 1, 5)), (1, dt.date(2020, 3, 1))], "k int, d date")
    assert rows(range_profile(spans, ["k"], "d")) == [(1, dt.date(2020, 1, 5), dt.date(2020, 3, 1), 2)]


def test_empty_months(spark):
    report = spark.createDataFrame([(dt.date(2019, 12, 1), 5)], "month date, n int")
    calendar = spark.createDataFrame([(dt.date(2019, 11, 30), dt.date(2020, 1, 1))], "first_date date, last_date date")
    got = with_empty_months(report, calendar, ["n"])
    assert rows(got) == [(dt.date(2019, 11, 1), 0), (dt.date(2019, 12, 1), 5), (dt.date(2020, 1, 1), 0)]


def test_unpivot_drops_null_and_casts(spark):
    df = spark.createDataFrame([(1, "AFG", 4), (2, None, 8), (3, None, None)], "id int, alpha string, num int")
    assert rows(unpivot_columns(df, ["id"], ["alpha", "num"], "code")) == [(1, "4"), (1, "AFG"), (2, "8")]
    assert unpivot_columns(df, ["id"], ["alpha", "num"], "code", "kind").columns == ["id", "kind", "code"]
