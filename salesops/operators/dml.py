"""Insert, update, delete and merge as functions from a table to its next version.

Parquet tables take no row changes, so each function returns the new content; store it
with ``storage.write_version``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.operators.ordered import with_position
from salesops.operators.skew import join_per_key
from salesops.sources.storage import materialize


def seed_rows(df_like: DataFrame, rows: list[dict]) -> DataFrame:
    """A few literal rows in the structure of ``df_like``; unnamed columns are NULL."""
    names = df_like.columns
    data = [tuple(r.get(c) for c in names) for r in rows]
    return df_like.sparkSession.createDataFrame(data, df_like.schema)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill NULL or absent columns with their defaults."""
    return df.withColumns({c: F.coalesce(F.col(c), d) if c in df.columns else d for c, d in defaults.items()})


def next_id_after(target: DataFrame, id_col: str) -> Column:
    """max(id) of a table (0 when empty) as a scalar subquery."""
    return F.coalesce(target.agg(F.max(id_col)).scalar(), F.lit(0))


def assign_ids(rows: DataFrame, id_col: str, order: list[Column], start: Column | int = 0) -> DataFrame:
    """Identity values start + 1, start + 2, ... in ``order``, without a one-task window."""
    start = start if isinstance(start, Column) else F.lit(start)
    placed = with_position(rows.drop(id_col), order, "_position")
    return placed.withColumn(id_col, (start + F.col("_position")).cast("bigint")).drop("_position")


def insert_rows(target: DataFrame, rows: DataFrame, id_col: str | None = None, order: list[Column] | None = None,
                defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Append rows; the identity column and the defaults are filled by the table, other absent columns are NULL."""
    if id_col:
        rows = assign_ids(rows, id_col, order or [F.col(c) for c in rows.columns if c != id_col], next_id_after(target, id_col))
    rows = with_defaults(rows, defaults or {})
    return target.unionByName(rows.select(*[c for c in target.columns if c in rows.columns]), allowMissingColumns=True)


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; all expressions see the old values."""
    return df.select(*[
        F.when(condition, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c) for c in df.columns
    ])


def update_all(df: DataFrame, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns on every row."""
    return update_where(df, F.lit(True), assignments)


def update_from(df: DataFrame, source: DataFrame, on: list[str], columns: Mapping[str, str]) -> DataFrame:
    """Fill ``df`` columns from the matching row of ``source`` (unique on ``on``); no match keeps the old value."""
    picked = source.select(*[F.col(k).alias(f"_on_{k}") for k in on], *[F.col(s).alias(f"_new_{c}") for c, s in columns.items()])
    joined = join_per_key(df, picked.dropna(subset=[f"_on_{k}" for k in on]), [(k, f"_on_{k}") for k in on], "left")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (false or unknown)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise when a non-NULL key occurs twice. Counts are combined on the map side; one row comes back."""
    known = df.select(*keys).dropna()
    if not known.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).isEmpty():
        raise ValueError(f"duplicate source keys: {', '.join(keys)}")


def merge(target: DataFrame, source: DataFrame, keys: list[str], updates: Mapping[str, Column],
          id_col: str | None = None, insert_defaults: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Upsert ``source`` into ``target``: (new target, change log).

    ``updates`` gives, for matched rows, the new value of a column as an expression over
    the source columns. Unmatched source rows are inserted with ``insert_defaults`` and
    the next identities. NULL keys match nothing. The log holds ``action`` and the
    ``old`` and ``new`` images of each changed row.

    The target is the left side of a left join: a source small enough to broadcast leaves
    the target unshuffled, a large one is a sort-merge join that AQE can split. Known keys
    are found by semi-joining the target's key column alone. The source is stored once,
    as it is read for the check, the updates and the inserts.
    """
    source = materialize(source)
    require_unique(source, keys)
    cols = target.columns
    changes = source.select(
        *[F.col(k).alias(f"_on_{k}") for k in keys],
        *[e.alias(f"_set_{c}") for c, e in updates.items()],
        F.lit(True).alias("_hit"),
    )
    match = [target[k] == changes[f"_on_{k}"] for k in keys]
    joined = target.join(changes, match, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))

    def new_value(c: str) -> Column:
        return F.when(hit, F.col(f"_set_{c}")).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)

    kept = joined.select(*[new_value(c) for c in cols])

    known = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    fresh = with_defaults(source.join(known, keys, "left_anti"), insert_defaults or {})
    if id_col:
        fresh = assign_ids(fresh, id_col, [F.col(k) for k in keys], next_id_after(target, id_col))
    inserted = fresh.select(*[
        (F.col(c) if c in fresh.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in cols
    ])

    image = F.struct(*[F.col(c) for c in cols])
    changed = joined.filter(hit).select(
        F.lit("UPDATE").alias("action"),
        image.alias("old"),
        F.struct(*[new_value(c).alias(c) for c in cols]).alias("new"),
    )
    added = inserted.select(
        F.lit("INSERT").alias("action"),
        F.lit(None).cast(changed.schema["old"].dataType).alias("old"),
        image.alias("new"),
    )
    return kept.unionByName(inserted), changed.unionByName(added)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], updates: Mapping[str, Column], **options) -> DataFrame:
    """The merged table; see ``merge``."""
    return merge(target, source, keys, updates, **options)[0]


def upsert_log(target: DataFrame, source: DataFrame, keys: list[str], updates: Mapping[str, Column], **options) -> DataFrame:
    """The change log of a merge; see ``merge``."""
    return merge(target, source, keys, updates, **options)[1]


def extend_dictionary(dim: DataFrame, source: DataFrame, name_col: str, id_col: str,
                      attributes: Mapping[str, Column] | None = None,
                      defaults: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Add the source's unknown non-empty names to a dictionary: (dictionary, added rows).

    ``attributes`` are further columns taken from the source, as aggregates per name
    (a name seen with two values still gives one row).
    """
    named = source.filter(F.col(name_col).isNotNull() & (F.col(name_col) != ""))
    if attributes:
        names = named.groupBy(name_col).agg(*[e.alias(c) for c, e in attributes.items()])
    else:
        names = named.select(name_col).distinct()
    unknown = names.join(dim.select(name_col), name_col, "left_anti")
    rows = assign_ids(unknown, id_col, [F.col(name_col)], next_id_after(dim, id_col))
    rows = with_defaults(rows, defaults or {})
    added = rows.select(*[
        (F.col(c) if c in rows.columns else F.lit(None)).cast(dim.schema[c].dataType).alias(c) for c in dim.columns
    ])
    return dim.unionByName(added), added
