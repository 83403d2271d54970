"""Aggregation helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.operators.ordered import with_position
from salesops.operators.skew import join_per_key


def weighted_mean(amount: Column, weight: Column) -> Column:
    """sum(amount) / sum(weight); NULL for a zero weight."""
    return F.try_divide(F.sum(amount), F.sum(weight))


def collapse_duplicates(df: DataFrame) -> DataFrame:
    """One row per identical row."""
    return df.dropDuplicates()


def ordered_text(df: DataFrame, keys: list[str], col: str, separator: str = ",") -> DataFrame:
    """Per key, the distinct values of ``col`` in order, in one text.

    Repetitions are removed before the values meet, so the cost of a key
    follows its number of different values, not its number of rows.
    """
    return (
        df.select(*keys, F.col(col).alias("_value"))
        .distinct()
        .groupBy(*keys)
        .agg(F.expr(f"listagg(_value, '{separator}') WITHIN GROUP (ORDER BY _value)").alias(f"{col}_list"))
    )


def ordered_text_parts(df: DataFrame, keys: list[str], col: str, separator: str = ",", width: int = 1000) -> DataFrame:
    """Per key, the distinct values of ``col`` in order, as texts of up to ``width`` values with a part number from 1 (``part``).

    For keys with very many different values: their places come from range partitions, which may be cut inside a key, and no task
    joins more than ``width`` values. The parts in their order, joined by the separator, are the whole text of ``ordered_text``. A key
    with NULLs only has one part, whose text is NULL.
    """
    values = df.select(*keys, F.col(col).alias("_value")).distinct()
    some = values.filter(F.col("_value").isNotNull())
    placed = with_position(some, [*[F.col(k).asc() for k in keys], F.col("_value").asc()], "_at")
    first = placed.groupBy(*[F.col(k).alias(f"_first_{k}") for k in keys]).agg(F.min("_at").alias("_start"))
    pairs = [(k, f"_first_{k}") for k in keys]
    parts = join_per_key(placed, first, pairs, "inner").withColumn("part", F.floor((F.col("_at") - F.col("_start")) / width) + 1)
    text = F.expr(f"listagg(_value, '{separator}') WITHIN GROUP (ORDER BY _value)")
    texts = parts.groupBy(*keys, "part").agg(text.alias(f"{col}_list"))
    empty = join_per_key(values.filter(F.col("_value").isNull()), first, pairs, "left_anti")
    return texts.unionByName(empty.select(*keys, F.lit(1).cast("bigint").alias("part"), F.lit(None).cast("string").alias(f"{col}_list")))


def range_profile(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """First date, last date and number of rows per key."""
    return df.groupBy(*keys).agg(
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def with_empty_months(report: DataFrame, calendar: DataFrame, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """Fill months absent from ``report`` with zeros.

    ``calendar`` holds the key columns (none for one overall series) with
    ``first_date`` and ``last_date``; each of its rows is expanded to its own months.
    ``report`` carries the same keys and a ``month`` (first day).
    """
    keys = keys or []
    months = calendar.select(
        *keys,
        F.explode(
            F.sequence(F.trunc("first_date", "MM"), F.trunc("last_date", "MM"), F.expr("interval 1 month"))
        ).alias("month"),
    )
    joined = months.join(report, [*keys, "month"], "left")
    return joined.select(*keys, "month", *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])
