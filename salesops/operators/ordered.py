"""Windows over a whole table (no partition key) without gathering it in one task.

The rows are range-partitioned and sorted by the order columns, each row's slot
(partition, place) is written to a Parquet table, and only the row counts per partition
meet in one place. A row's position is then its place plus the rows of the partitions
before it. Positions give running counts, tiles and dense ranks by arithmetic and equi-joins,
and neighbours by a window inside each range partition.

The written table is what makes this safe: a lost executor re-reads files, it does not
re-sample the ranges and get different slots.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesops.operators.skew import join_per_key
from salesops.sources.storage import materialize

_SLOT_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


class Neighbour(NamedTuple):
    """A value taken ``offset`` rows further (negative: back), ``default`` where there is no such row."""

    col: str
    offset: int
    name: str
    default: object = None


def _slots(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` stored with ``_bucket`` (its range partition) and ``_place`` (1-based within it)."""
    slotted = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    bucket = F.shiftright("_slot", _SLOT_BITS)
    place = F.col("_slot") - F.shiftleft(bucket, _SLOT_BITS) + 1
    return materialize(slotted).withColumns({"_bucket": bucket, "_place": place}).drop("_slot")


def _bucket_sums(slots: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per bucket, each sum over the bucket (``name``), over the buckets before it (``name_before``) and over all (``name_all``).

    One row per range partition: bounded by spark.sql.shuffle.partitions, not by the data.
    """
    parts = slots.groupBy("_bucket").agg(*[e.alias(n) for n, e in sums.items()])
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return parts.select(
        "_bucket",
        *sums,
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in sums],
        *[F.sum(n).over(whole).alias(f"{n}_all") for n in sums],
    )


def with_position(df: DataFrame, order: list[Column], name: str = "position", total: str | None = None,
                  neighbours: list[Neighbour] | None = None) -> DataFrame:
    """Add the 1-based position of each row in the total order ``order``, and optionally the number of
    rows and values of neighbouring rows (lead and lag).

    ``order`` must identify rows uniquely; its unique tail also lets the range
    partitioner split a value that many rows share.
    """
    slots = _slots(df, order)
    sizes = _bucket_sums(slots, {"_rows": F.count(F.lit(1))})
    placed = slots.join(F.broadcast(sizes), "_bucket").withColumn(name, F.col("_rows_before") + F.col("_place"))
    placed = placed.withColumnRenamed("_rows_all", total) if total else placed.drop("_rows_all")
    placed = placed.drop("_place", "_rows", "_rows_before")
    if neighbours:
        placed = _with_neighbours(placed, sizes, name, neighbours)
    return placed.drop("_bucket")


def _with_neighbours(placed: DataFrame, sizes: DataFrame, position: str, neighbours: list[Neighbour]) -> DataFrame:
    """lead and lag as one window inside each bucket, after lending each bucket the few rows on either side of it.

    The lent rows are found by their positions and number at most twice the reach per bucket, so they are bounded
    by the number of range partitions; a bucket shorter than the reach borrows across several.
    """
    reach = max(abs(n.offset) for n in neighbours)
    start, end = F.col("_rows_before") + 1, F.col("_rows_before") + F.col("_rows")
    wanted = F.concat(F.sequence(start - reach, start - 1), F.sequence(end + 1, end + reach))
    lent = placed.drop("_bucket").join(F.broadcast(sizes.select("_bucket", F.explode(wanted).alias(position))), position)
    rows = placed.withColumn("_lent", F.lit(False)).unionByName(lent.withColumn("_lent", F.lit(True)))
    bucket = W.partitionBy("_bucket").orderBy(position)
    values = {
        n.name: (F.lead(n.col, n.offset, n.default) if n.offset > 0 else F.lag(n.col, -n.offset, n.default)).over(bucket)
        for n in neighbours
    }
    return rows.withColumns(values).filter("not _lent").drop("_lent")


def tile(position: Column, total: Column, tiles: int) -> Column:
    """ntile(tiles) from a position: the first ``total mod tiles`` tiles hold one row more."""
    size = F.floor(total / tiles)
    longer = total - size * tiles
    cut = longer * (size + 1)
    in_long = F.floor((position - 1) / (size + 1)) + 1
    in_short = longer + F.floor((position - 1 - cut) / F.greatest(size, F.lit(1))) + 1
    return F.when(position <= cut, in_long).otherwise(in_short).cast("int")


def dense_ranks(df: DataFrame, keys: list[str], order_col: str, name: str) -> DataFrame:
    """The different (keys, order_col) values with their dense_rank() OVER (PARTITION BY keys ORDER BY order_col).

    The different pairs are positioned as one ordered list; a rank is the distance from the key's first pair.
    """
    pairs = df.select(*keys, order_col).distinct()
    placed = with_position(pairs, [F.col(c).asc() for c in pairs.columns], "_at")
    first = placed.groupBy(*[F.col(k).alias(f"_first_{k}") for k in keys]).agg(F.min("_at").alias("_start"))
    ranks = join_per_key(placed, first, [(k, f"_first_{k}") for k in keys], "inner")
    return ranks.select(*pairs.columns, (F.col("_at") - F.col("_start") + 1).cast("int").alias(name))


def with_dense_rank(df: DataFrame, keys: list[str], order_col: str, name: str) -> DataFrame:
    """Each row with its dense_rank() OVER (PARTITION BY keys ORDER BY order_col), for groups of any size."""
    cols = [*keys, order_col]
    ranks = dense_ranks(df, keys, order_col, name).select(*[F.col(c).alias(f"_rank_{c}") for c in cols], name)
    return join_per_key(df, ranks, [(c, f"_rank_{c}") for c in cols], "left").drop(*[f"_rank_{c}" for c in cols])


def running_sum(df: DataFrame, order_col: str, values: dict[str, Column]) -> DataFrame:
    """sum(value) OVER (ORDER BY order_col), default RANGE frame, for each named value.

    Values are summed per order value first (rows equal in ``order_col`` share their
    running sum). Within a range partition the sum runs over that partition only;
    the totals of the partitions before are added from a table with one row per partition.
    """
    parts = {f"_sum_{n}": F.sum(n) for n in values}
    sums = df.groupBy(order_col).agg(*[F.sum(e).alias(n) for n, e in values.items()])
    slots = _slots(sums, [F.col(order_col)])
    inside = W.partitionBy("_bucket").orderBy("_place")
    run = slots.join(F.broadcast(_bucket_sums(slots, parts)), "_bucket").select(
        F.col(order_col).alias("_at"), *[(F.col(f"_sum_{n}_before") + F.sum(n).over(inside)).alias(n) for n in values]
    )
    return join_per_key(df, run, [(order_col, "_at")], "left").drop("_at")
