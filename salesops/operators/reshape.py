"""Pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.functions.texts import quoted_name


def pivot_sum(df: DataFrame, row: str, col: str, values: list[str], value: str) -> DataFrame:
    """One row per ``row``, one column per listed value, cells summed; an absent cell is NULL.

    Rows outside the list still give their ``row`` a line. The two-step pivot
    aggregates (row, column) pairs on the map side first.
    """
    cells = df.groupBy(row, col).agg(F.sum(value).alias("_cell"))
    return cells.groupBy(row).pivot(col, values).agg(F.sum("_cell"))


def pivot_values(df: DataFrame, col: str, limit: int) -> list[str]:
    """The sorted values of ``col``; more than ``limit`` are an error.

    At most limit + 1 values reach the driver.
    """
    found = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{col} has more than {limit} values: too many columns for a table, use long_cells")
    return sorted(r[0] for r in found)


def pivot_dynamic(df: DataFrame, row: str, col: str, value: str, names: DataFrame | None = None, limit: int = 2000) -> DataFrame:
    """Pivot whose column list is read from the data (from ``names`` when given).

    A column list longer than ``limit`` is no usable table and raises an error; ``long_cells`` gives the same cells as
    rows, whatever their number. The result's columns depend on the data, its form does not.
    """
    return pivot_sum(df, row, col, pivot_values(names if names is not None else df, col, limit), value)


def long_cells(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """The cells of a pivot as rows."""
    return df.groupBy(row, col).agg(F.sum(value).alias(value))


def unpivot_columns(df: DataFrame, keys: list[str], cols: list[str], value: str, name: str | None = None) -> DataFrame:
    """Several columns into one, cast to text where their types differ; NULL values give no row."""
    types = {df.schema[c].dataType for c in cols}
    if len(types) > 1:
        df = df.select(*[F.col(quoted_name(k)) for k in keys], *[F.col(quoted_name(c)).cast("string").alias(c) for c in cols])
    named = [[F.col(quoted_name(c)) for c in group] for group in (keys, cols)]
    long = df.unpivot(*named, name or "_name", value).filter(F.col(quoted_name(value)).isNotNull())
    return long if name else long.drop("_name")
