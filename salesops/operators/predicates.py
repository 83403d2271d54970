"""Filters and membership tests."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.functions.dates import month_bounds
from salesops.operators.skew import join_per_key


def like_any(col: Column | str, patterns: list[str], ignore_case: bool = False) -> Column:
    """True where ``col`` matches one of the LIKE patterns."""
    col = F.col(col) if isinstance(col, str) else col
    tests = [col.ilike(p) if ignore_case else col.like(p) for p in patterns]
    return reduce(lambda a, b: a | b, tests)


def in_trimmed(col: Column | str, values: list[str]) -> Column:
    """IN list after trimming blanks."""
    return F.trim(col).isin(values)


def in_period(df: DataFrame, col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both days included.

    Written as a half-open range on the raw column, so that it is pushed to the
    scan and prunes row groups; a cast or year() on the column would not be. Where the table is stored by the
    month of ``col`` (a column ``<col>_month``), the months of the period are put on that column too, and
    the files of other months are not read.
    """
    rows = df.filter((F.col(col) >= F.lit(start)) & (F.col(col) < F.lit(end + dt.timedelta(days=1))))
    if f"{col}_month" in df.columns:
        rows = rows.filter(F.col(f"{col}_month").between(F.lit(start.replace(day=1)), F.lit(end)))
    return rows


def in_month(df: DataFrame, col: str, year: int, month: int) -> DataFrame:
    """Rows of one calendar month."""
    return in_period(df, col, *month_bounds(year, month))


def keep_in(df: DataFrame, ids: DataFrame, on: list[str], unique: bool = False) -> DataFrame:
    """Rows whose key occurs in ``ids`` (IN subquery).

    Repeated ids are collapsed on the map side first. ``unique`` is for keys read straight from a table, which
    need no collapsing; that saves a shuffle. Either way AQE can split a frequent key of ``df``.
    """
    if unique:
        return df.join(ids.select(*on), on, "left_semi")
    keys = ids.select(*[F.col(c).alias(f"_in_{c}") for c in on]).distinct()
    return join_per_key(df, keys.dropna(), [(c, f"_in_{c}") for c in on], "left_semi")


def not_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """SQL NOT IN, with its NULL rules, as a shuffled anti join.

    Spark's own NOT IN must broadcast the whole id list. The rules are instead
    tested on two counts of the list: an empty list keeps every row, a list
    with a NULL keeps none, and otherwise a NULL key is not kept.
    """
    ids = ids.select(key)
    counts = ids.agg(F.struct(F.count(F.lit(1)).alias("total"), F.count(key).alias("known"))).scalar()
    left_over = df.join(ids.distinct(), key, "left_anti").withColumn("_ids", counts)
    kept = (F.col("_ids.total") == 0) | ((F.col("_ids.total") == F.col("_ids.known")) & F.col(key).isNotNull())
    return left_over.filter(kept).drop("_ids")
