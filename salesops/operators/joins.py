"""Join shapes.

No side is force-broadcast here: Catalyst broadcasts a side by its estimated
size and AQE by its measured size, and anything larger is a sort-merge join whose
skewed partitions AQE splits. Where a many-rows-per-key side only feeds a sum, it
is aggregated before the join; where it is only tested for existence, it is reduced to its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesops.operators.skew import join_per_key


def lookup(df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a dimension: attributes or NULL. A key that the dimension holds twice doubles its rows; see ``scalar_lookup``."""
    return df.join(dim, on, "left")


def scalar_lookup(df: DataFrame, dim: DataFrame, on: list[str], col: str) -> DataFrame:
    """Each row with the one ``col`` of its key, or NULL; a key with two rows in ``dim`` fails the job, as a scalar subquery does."""
    found = dim.groupBy(*[F.col(c).alias(f"_dim_{c}") for c in on]).agg(F.min(col).alias(col), F.count(F.lit(1)).alias("_rows"))
    key = F.concat_ws(",", *[F.col(f"_dim_{c}").cast("string") for c in on])
    checked = found.withColumn(col, F.when(F.col("_rows") == 1, F.col(col)).otherwise(F.raise_error(F.concat(F.lit("more than one row for key "), key))))
    return join_per_key(df, checked.drop("_rows"), [(c, f"_dim_{c}") for c in on], "left").drop(*[f"_dim_{c}" for c in on])


def without_related(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Distinct rows of ``left`` with no partner in ``right``; the many rows of ``right`` are reduced to their keys first.

    NULL keys have no partner. A key with many rows in ``left`` can be split (``join_per_key``).
    """
    return join_per_key(left, _keys(right, on), [(c, f"_right_{c}") for c in on], "left_anti").distinct()


def _keys(df: DataFrame, on: list[str]) -> DataFrame:
    """The different keys without NULL, as ``_right_...`` columns."""
    return df.select(*[F.col(c).alias(f"_right_{c}") for c in on]).dropna().distinct()


def without_related_full(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """The same result written as a full outer join that keeps rows without a partner.

    A full outer join cannot be split, so it meets keys only, one row for each key of either side; the rows of ``left`` are
    then joined to the keys left alone, which can.
    """
    mine = left.select(*[F.col(c).alias(f"_left_{c}") for c in on]).distinct()
    match = [F.col(f"_left_{c}") == F.col(f"_right_{c}") for c in on]
    joined = mine.withColumn("_left", F.lit(True)).join(_keys(right, on), match, "full")
    alone = joined.filter(F.col("_left") & F.col(f"_right_{on[0]}").isNull()).select(*[f"_left_{c}" for c in on])
    return join_per_key(left, alone, [(c, f"_left_{c}") for c in on], "left_semi").distinct()


def apply_rows(outer: DataFrame, inner: DataFrame, on: list[str], keep_unmatched: bool = False) -> DataFrame:
    """Rows of ``inner`` for each row of ``outer`` (CROSS APPLY; OUTER APPLY keeps rows without any).

    The kept rows are added by an anti join: in a left outer join a key with many rows in ``inner`` could not be split.
    """
    found = outer.join(inner, on)
    if not keep_unmatched:
        return found
    rest = join_per_key(outer, _keys(inner, on), [(c, f"_right_{c}") for c in on], "left_anti")
    return found.unionByName(rest, allowMissingColumns=True)


def top_n_per_outer(outer: DataFrame, inner: DataFrame, on: list[str], order: list[Column], n: int) -> DataFrame:
    """For each row of ``outer`` its first ``n`` rows of ``inner``.

    ``inner`` is cut to n rows per key first; the cut starts on the map side
    (window group limit), so a hot key never reaches one task whole.
    """
    cut = (
        inner.withColumn("_place", F.row_number().over(W.partitionBy(*on).orderBy(*order)))
        .filter(F.col("_place") <= n)
        .drop("_place")
    )
    return apply_rows(outer, cut, on)


def match_counts(df: DataFrame, on: list[str], name: str = "matches") -> DataFrame:
    """Rows per key: the factor by which a fan-out join on that key multiplies its other side."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias(name))
