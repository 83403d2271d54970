"""Sorting, top-n and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.operators.ordered import with_position
from salesops.operators.skew import same_keys

def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows; each task keeps n rows only. ``order`` must end in a unique tie-break."""
    return df.orderBy(*order).limit(n)


def top_n_distinct(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` different rows."""
    return df.distinct().orderBy(*order).limit(n)


def top_with_ties(df: DataFrame, order: dict[str, bool], n: int) -> DataFrame:
    """First ``n`` rows and all rows equal to the last of them in the order columns.

    ``order`` maps column to True for descending. The order values of the first n rows
    (at most n of them) select their rows by a semi join: ties stay distributed,
    however many there are, and no window is needed.
    """
    sort = [F.col(c).desc() if down else F.col(c).asc() for c, down in order.items()]
    best = df.select(*order).orderBy(*sort).limit(n).distinct()
    best = best.select(*[F.col(c).alias(f"_best_{c}") for c in order])
    return df.join(best, same_keys(df, best, [(c, f"_best_{c}") for c in order]), "left_semi")


def page(df: DataFrame, order: list[Column], start: int, width: int, num: int = 1) -> DataFrame:
    """Rows of page ``num`` (from 1): skip start + (num - 1) * width rows, take ``width``.

    A top-k with offset: the skipped rows meet in one task, so this is for the first pages; see ``deep_page``.
    """
    return df.orderBy(*order).offset(start + (num - 1) * width).limit(width)


def deep_page(df: DataFrame, order: list[Column], start: int, width: int, num: int = 1) -> DataFrame:
    """The same page, however deep, cut by distributed positions: every row is sorted and stored once."""
    skip = start + (num - 1) * width
    placed = with_position(df, order, "_row")
    return placed.filter((F.col("_row") > skip) & (F.col("_row") <= skip + width)).drop("_row")


def _after(order: dict[str, bool], key: dict) -> Column:
    """The rows that come after ``key`` in the order; NULL comes first ascending and last descending, as Spark sorts it."""
    further = F.lit(False)
    for name, down in reversed(order.items()):
        col, value = F.col(name), key[name]
        if value is None:
            beyond, tie = F.lit(False) if down else col.isNotNull(), col.isNull()
        else:
            beyond, tie = (col < value) | col.isNull() if down else col > value, col == value
        further = beyond | (tie & further)
    name, down = next(iter(order.items()))
    col, value = F.col(name), key[name]
    # implied, but a comparison of one column is what the scan takes
    if value is None:
        return (col.isNull() & further) if down else further
    return ((col <= value) | col.isNull() if down else col >= value) & further


def page_after(df: DataFrame, order: dict[str, bool], width: int, after: dict | None = None) -> DataFrame:
    """The first ``width`` rows after the row with the order values ``after`` (from the start without it).

    ``order`` maps column to True for descending and must identify rows. The comparison reaches the scan, and the rest is a top-k: a
    page costs the same however deep it lies, and nothing is sorted or stored as a whole. Rows that come or go before the key
    do not shift the page.
    """
    sort = [F.col(c).desc() if down else F.col(c).asc() for c, down in order.items()]
    rows = df if after is None else df.filter(_after(order, after))
    return rows.orderBy(*sort).limit(width)


def last_key(page_rows: DataFrame, order: dict[str, bool]) -> dict | None:
    """The order values of a page's last row, from which the next page goes on; None for an empty page."""
    back = [F.col(c).asc() if down else F.col(c).desc() for c, down in order.items()]
    row = page_rows.select(*order).orderBy(*back).first()
    return row.asDict() if row else None


def arg_max(df: DataFrame, value: str, tie_break: list[Column]) -> DataFrame:
    """The one row with the greatest ``value``."""
    return top_n(df, [F.col(value).desc(), *tie_break], 1)
