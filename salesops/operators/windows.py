"""Windows inside a key, in forms that do not gather a hot key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from salesops.operators.skew import join_per_key


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "place") -> DataFrame:
    """First ``n`` rows per key with their number; ``order`` must end in a unique tie-break.

    The row-number filter becomes a window group limit: each map task passes on
    at most n rows per key.
    """
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)


def latest_values(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The greatest ``order_col`` of each key, as ``latest_rows`` takes it (``_key_...``, ``_best``)."""
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.max(order_col).alias("_best"))


def latest_rows(df: DataFrame, keys: list[str], order_col: str, best: DataFrame | None = None) -> DataFrame:
    """All rows that carry the greatest ``order_col`` of their key (dense_rank = 1), ties kept.

    The maximum per key is a map-side aggregate and the ties are found by a join that
    AQE can split, so neither a hot key nor a hot tie ends up in one task. ``best`` gives maxima that are stored already
    (``latest_values``).
    """
    best = latest_values(df, keys, order_col) if best is None else best
    pairs = [(k, f"_key_{k}") for k in keys] + [(order_col, "_best")]
    return join_per_key(df, best, pairs, "left_semi")


def within_top_values(df: DataFrame, keys: list[str], col: str, n: int) -> DataFrame:
    """Rows whose ``col`` is among the ``n`` greatest different values of their key (dense_rank <= n)."""
    values = df.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col(col).alias("_value")).distinct()
    own = [f"_key_{k}" for k in keys]
    top = top_n_per_group(values, own, [F.col("_value").desc_nulls_last()], n, "_place").drop("_place")
    pairs = [(k, f"_key_{k}") for k in keys] + [(col, "_value")]
    return join_per_key(df, top, pairs, "left_semi")


def with_group_total(df: DataFrame, keys: list[str], totals: list[Column]) -> DataFrame:
    """Each row with aggregates of its whole key (an aggregate OVER (PARTITION BY keys))."""
    sums = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(*totals)
    joined = join_per_key(df, sums, [(k, f"_key_{k}") for k in keys], "left")
    return joined.drop(*[f"_key_{k}" for k in keys])


def _calendar(df: DataFrame, date_col: str, value: str) -> DataFrame:
    """One row per day of ``date_col`` with the sum of ``value``: what a calendar bounds may meet in one task."""
    if not isinstance(df.schema[date_col].dataType, T.DateType):
        raise TypeError(f"{date_col} must be a date: only a calendar bounds the rows of a running total")
    return df.groupBy(date_col).agg(F.sum(value).alias(value))


def running_total(df: DataFrame, date_col: str, value: str, name: str) -> DataFrame:
    """Running sum over a calendar: a row for each date with its sum and the running one.

    Rows are summed per date first, so the window that runs in one task gets one row per date.
    """
    return _calendar(df, date_col, value).withColumn(name, F.sum(value).over(W.orderBy(date_col)))


def running_total_lookup(df: DataFrame, date_col: str, value: str, name: str) -> DataFrame:
    """The same running sum without a window: each date adds up the dates not after it.

    The dates of the calendar travel as one array from a scalar subquery, so
    there is no inequality join.
    """
    sums, order_col = _calendar(df, date_col, value), date_col
    steps = sums.agg(F.collect_list(F.struct(F.col(order_col).alias("at"), F.col(value).alias("v"))))
    total = F.aggregate(
        F.filter(F.col("_steps"), lambda s: s["at"] <= F.col(order_col)),
        F.lit(0).cast("bigint"),
        lambda acc, s: acc + F.coalesce(s["v"], F.lit(0)),
    )
    return sums.withColumn("_steps", steps.scalar()).withColumn(name, total).drop("_steps")


def month_totals_window(df: DataFrame, month: Column, value: str, name: str) -> DataFrame:
    """Monthly totals as an unbounded RANGE window collapsed by DISTINCT.

    The frame covers the whole partition, so the rows are first reduced to one
    partial sum per month; the window then sees one row per month.
    """
    partial = df.groupBy(month.alias("month")).agg(F.sum(value).alias("_part"))
    frame = W.partitionBy("month").orderBy("month").rangeBetween(W.unboundedPreceding, W.unboundedFollowing)
    return partial.select("month", F.sum("_part").over(frame).alias(name)).distinct()
