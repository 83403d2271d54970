"""Declared constraints as checks; each returns the violating rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_fields(df: DataFrame, keys: list[str], not_null: list[str], max_length: dict[str, int]) -> DataFrame:
    """One row per broken field rule: keys, column, rule. One pass over the table."""
    rules = [F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("column_name"), F.lit("not null").alias("rule"))) for c in not_null]
    rules += [
        F.when(F.length(c) > n, F.struct(F.lit(c).alias("column_name"), F.lit(f"length <= {n}").alias("rule")))
        for c, n in max_length.items()
    ]
    return df.select(*keys, F.explode(F.array_compact(F.array(*rules))).alias("_broken")).select(*keys, "_broken.*")


def check_foreign_key(child: DataFrame, parent: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of ``child`` whose non-NULL key has no row in ``parent``; ``columns`` maps child to parent."""
    keys = parent.select(*[F.col(p).alias(f"_parent_{c}") for c, p in columns.items()])
    orphans = child.join(keys, [child[c] == keys[f"_parent_{c}"] for c in columns], "left_anti")
    return orphans.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def check_primary_key(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
