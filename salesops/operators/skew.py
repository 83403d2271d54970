"""Joins of many rows to one row per key, where a key may hold a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """NULL-safe equality of key pairs, as a window partition compares them."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def join_per_key(df: DataFrame, per_key: DataFrame, pairs: list[tuple[str, str]], how: str) -> DataFrame:
    """Join ``df`` to an aggregate of the same key.

    An aggregate is already hashed by its key, and Spark would join on that layout; AQE splits a skewed
    partition only where both sides were shuffled for the join itself. The hash of the key, added
    as a further join key, has that effect: the small side moves once more, and a key that
    holds a third of all rows is read by many tasks.
    """
    left, right = [x for x, _ in pairs], [y for _, y in pairs]
    rows = df.withColumn("_key_hash", F.xxhash64(*left))
    other = per_key.withColumn("_key_hash_right", F.xxhash64(*right))
    match = same_keys(rows, other, pairs) & (rows["_key_hash"] == other["_key_hash_right"])
    return rows.join(other, match, how).drop("_key_hash", "_key_hash_right")
