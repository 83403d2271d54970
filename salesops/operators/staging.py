"""Staging load: buffer, name resolution, reconciliation with the stored postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.operators.aggregates import collapse_duplicates
from salesops.operators.predicates import in_month
from salesops.operators.skew import join_per_key

UNKNOWN_ID = -1
AMOUNT = "decimal(28,12)"
IDENTITY = ["carry_date", "id_client", "id_account", "id_agreement", "carry_ground", "extra_data"]


def staging_buffer(stage: DataFrame, year: int, month: int) -> DataFrame:
    """Staged postings of one month: identical rows once, times cut to the day."""
    rows = collapse_duplicates(in_month(stage, "carry_date", year, month))
    return rows.withColumn("carry_date", F.to_date("carry_date"))


def active(dim: DataFrame, at: Column) -> DataFrame:
    """Dictionary rows that are not deleted and still valid."""
    return dim.filter(~F.coalesce(F.col("is_del"), F.lit(False)) & (F.col("valid_to") > at))


def _ids_by_name(dim: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """One id per name (the oldest), so that resolving never multiplies postings."""
    return dim.groupBy(F.col(name_col).alias("_name")).agg(F.min(id_col).alias(id_col))


def resolve_ids(buffer: DataFrame, clients: DataFrame, agreements: DataFrame, accounts: DataFrame) -> DataFrame:
    """Client, agreement and account ids by name; -1 where the name is unknown."""
    ids = [
        (_ids_by_name(clients, "client_name", "id_client"), "client_name", "id_client"),
        (_ids_by_name(agreements, "agreement_name", "id_agreement"), "agreement_name", "id_agreement"),
        (_ids_by_name(accounts, "account_name", "id_account"), "account_name", "id_account"),
    ]
    for dim, name, _ in ids:
        buffer = join_per_key(buffer, dim.filter(F.col("_name").isNotNull()), [(name, "_name")], "left").drop("_name")
    return buffer.withColumns({i: F.coalesce(F.col(i), F.lit(UNKNOWN_ID)) for _, _, i in ids})


def reconcile(buffer: DataFrame, stored: DataFrame, keys: list[str] = IDENTITY, amount: str = "vl") -> DataFrame:
    """Postings to append so that the stored sums per identity become the buffer's sums.

    Same sum: nothing. Different: a reversal of the stored sum and the new posting. Only
    in the buffer: the posting. Only stored: a reversal. A net of zero counts as
    absent on either side, so a second run over the result emits nothing.

    Both sides are tagged and summed in one aggregation: a single shuffle with map-side
    partial sums, NULL-safe on the keys, and no group is gathered.
    """
    exact = F.col(amount).cast(AMOUNT)
    zero = F.lit(0).cast(AMOUNT)
    both = buffer.select(*keys, exact.alias("_new"), zero.alias("_old")).unionByName(
        stored.select(*keys, zero.alias("_new"), exact.alias("_old"))
    )
    sums = both.groupBy(*keys).agg(F.sum("_new").cast(AMOUNT).alias("_new"), F.sum("_old").cast(AMOUNT).alias("_old"))
    differs = F.col("_new") != F.col("_old")

    def posting(name: str, value: Column, present: Column) -> Column:
        return F.when(present, F.struct(F.lit(name).alias("action"), value.cast(AMOUNT).alias(amount)))

    emitted = F.array_compact(F.array(
        posting("reversal", -F.col("_old"), F.col("_old") != 0),
        posting("insert", F.col("_new"), F.col("_new") != 0),
    ))
    out = sums.filter(differs).select(*keys, F.explode(emitted).alias("_row"))
    return out.select(*keys, "_row.action", f"_row.{amount}", F.lit(False).alias("is_del"))
