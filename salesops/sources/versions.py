"""Parquet tables that change: each version is a list of files, and a change writes only the files whose rows it touches.

Below a table's folder: ``data/_commit=N`` holds the files that commit N wrote, ``files/v=N`` lists the files that version N
consists of, and ``commits/v=N`` is one row about it, written last: a version exists once that row does. A change that is cut off
leaves no version and is written anew by the next try. Files are never changed, so readers of an older version go on undisturbed.
One writer at a time: a second one that commits the same version fails.

The identity mark, the highest id ever given out, is part of that row. It only rises: ids of deleted rows do not come back.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops.operators import dml
from salesops.operators.skew import join_per_key
from salesops.sources.storage import drop_stored, materialize

_COMMIT = "_commit"
_RECORD = "token string, last_id bigint, schema string, partitions array<string>, id_col string"


class Commit(NamedTuple):
    """What is known about a version."""

    version: int
    token: str | None
    last_id: int
    schema: T.StructType
    partitions: list[str]
    id_col: str | None


class VersionedTable:
    """A table in a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, df: DataFrame, path: str, partition_by: list[str] | None = None, id_col: str | None = None) -> VersionedTable:
        """Version 0. ``partition_by`` columns lay out the files (their values must need no escaping); ``id_col`` is an identity column."""
        table = cls(df.sparkSession, path)
        record = Commit(-1, None, 0, df.schema, list(partition_by or []), id_col)
        table._write(record, df, None, token=None)
        return table

    # reading

    def commits(self) -> DataFrame:
        """One row per version: v, token, last_id."""
        return self.spark.read.schema(f"{_RECORD}, v int").parquet(f"{self.path}/commits").select("v", "token", "last_id")

    def latest(self, version: int | None = None) -> Commit:
        records = self.spark.read.schema(f"{_RECORD}, v int").parquet(f"{self.path}/commits")
        row = (records if version is None else records.where(F.col("v") == version)).orderBy(F.col("v").desc()).first()
        if row is None:
            raise ValueError(f"no version {version} of {self.path}")
        return Commit(row.v, row.token, row.last_id, T.StructType.fromJson(json.loads(row.schema)), list(row.partitions), row.id_col)

    def _listed(self, record: Commit) -> list[str]:
        """The files of a version; Spark's own listing keeps as many paths on the driver."""
        rows = self.spark.read.schema("file string").parquet(f"{self.path}/files/v={record.version}").collect()
        return [f"{self.path}/data/{r.file}" for r in rows]

    def _scan(self, record: Commit, files: list[str], named: bool = False) -> DataFrame:
        """The rows of some files; ``named`` adds the file that each row lies in."""
        if not files:
            empty = self.spark.createDataFrame([], record.schema)
            return empty.withColumn("_file", F.lit(None).cast("string")) if named else empty
        schema = T.StructType([*record.schema.fields, T.StructField(_COMMIT, T.IntegerType())])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*files)
        name = F.substring_index(F.col("_metadata.file_path"), f"/data/{_COMMIT}=", -1)
        return rows.select(*[F.col(f"`{c}`") for c in record.schema.names], *[F.concat(F.lit(f"{_COMMIT}="), name).alias("_file")] * named)

    def read(self, version: int | None = None) -> DataFrame:
        """A version's rows (the latest by default), with partition and column pruning as for any Parquet table."""
        record = self.latest(version)
        return self._scan(record, self._listed(record))

    def files(self, version: int | None = None) -> list[str]:
        return sorted(self._listed(self.latest(version)))

    # changing

    def _done(self, token: str | None) -> int | None:
        """The version that a token already made."""
        if token is None:
            return None
        row = self.commits().where(F.col("token") == token).orderBy("v").first()
        return None if row is None else row.v

    def _write(self, before: Commit, added: DataFrame, replaced: set[str] | None, token: str | None) -> int:
        """Commit ``added`` in place of the ``replaced`` files (all, when None)."""
        version = before.version + 1
        data = f"{self.path}/data/{_COMMIT}={version}"
        rows = added.select(*[F.col(f"`{c}`").cast(before.schema[c].dataType).alias(c) for c in before.schema.names])
        if before.partitions:
            rows = rows.hint("rebalance", *before.partitions)
        rows.write.mode("overwrite").partitionBy(*before.partitions).parquet(data)
        written = self.spark.read.schema(before.schema).option("basePath", data).parquet(data)
        name = F.substring_index(F.col("_metadata.file_path"), f"/data/{_COMMIT}={version}/", -1)
        listed = written.select(F.concat(F.lit(f"{_COMMIT}={version}/"), name).alias("file")).distinct()
        listed = listed.select(F.when(F.contains("file", F.lit("%")), F.raise_error(F.lit("partition values must need no escaping"))).otherwise(F.col("file")).alias("file"))
        if replaced is not None:
            old = self.spark.read.schema("file string").parquet(f"{self.path}/files/v={before.version}")
            gone = self.spark.createDataFrame([(f,) for f in sorted(replaced)], "file string")
            listed = listed.unionByName(old.join(gone, "file", "left_anti"))
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/files/v={version}")
        mark = before.last_id
        if before.id_col:
            top = written.agg(F.max(before.id_col)).first()[0] or 0
            mark = max(mark, top)
        record = [(token, mark, before.schema.json(), before.partitions, before.id_col)]
        self.spark.createDataFrame(record, _RECORD).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/v={version}")
        return version

    def _touched(self, rows: DataFrame) -> set[str]:
        """The files of some rows: as many names as there are files at most."""
        return {r._file for r in rows.select("_file").distinct().collect()}

    def _change(self, condition: Column, changed: Callable[[DataFrame], DataFrame], token: str | None) -> int:
        before = self.latest()
        done = self._done(token)
        if done is not None:
            return done
        scan = self._scan(before, self._listed(before), named=True)
        touched = self._touched(scan.where(condition))
        if not touched:
            return self._write(before, self.spark.createDataFrame([], before.schema), touched, token)
        rows = self._scan(before, [f"{self.path}/data/{f}" for f in sorted(touched)])
        return self._write(before, changed(rows), touched, token)

    def update_where(self, condition: Column, assignments: Mapping[str, Column], token: str | None = None) -> int:
        """Set columns where the condition is true; the new version's number. Files without such a row stay as they are."""
        return self._change(condition, lambda rows: dml.update_where(rows, condition, assignments), token)

    def delete_where(self, condition: Column, token: str | None = None) -> int:
        """Remove rows where the condition is true."""
        return self._change(condition, lambda rows: dml.delete_where(rows, condition), token)

    def insert(self, rows: DataFrame, order: list[Column] | None = None, defaults: Mapping[str, Column] | None = None, token: str | None = None) -> int:
        """Append rows; no old file is touched. An identity column goes on after the mark, in ``order``.

        With a ``token``, an insert that was already made under it is not made again.
        """
        before = self.latest()
        done = self._done(token)
        if done is not None:
            return done
        if before.id_col:
            order = order or [F.col(f"`{c}`") for c in rows.columns if c != before.id_col]
            rows = dml.assign_ids(rows, before.id_col, order, before.last_id)
        rows = dml.with_defaults(rows, defaults or {})
        empty = self.spark.createDataFrame([], before.schema)
        fresh = empty.unionByName(rows.select(*[c for c in before.schema.names if c in rows.columns]), allowMissingColumns=True)
        return self._write(before, fresh, set(), token)

    def merge(self, source: DataFrame, keys: list[str], updates: Mapping[str, Column], insert_defaults: Mapping[str, Column] | None = None,
              token: str | None = None) -> tuple[int, DataFrame]:
        """Upsert ``source`` as ``dml.merge`` does: the new version's number and the change log (action, old, new).

        The keys of the table are read once to find the files that hold a match. These files' rows are joined to the source once
        and stored; the new files, the log and the known keys come from that. Rows of other files are neither read whole nor written.
        """
        before = self.latest()
        done = self._done(token)
        if done is not None:
            return done, self.log(done)
        source = materialize(source)
        dml.require_unique(source, keys)
        names = before.schema.names
        wanted = source.select(*[F.col(f"`{k}`").alias(f"_on_{k}") for k in keys]).dropna()
        pairs = [(k, f"_on_{k}") for k in keys]
        scan = self._scan(before, self._listed(before), named=True)
        touched = self._touched(join_per_key(scan.select(*keys, "_file"), wanted, pairs, "left_semi"))
        changes = source.dropna(subset=keys).select(
            *[F.col(f"`{k}`").alias(f"_on_{k}") for k in keys], F.struct(*[e.alias(c) for c, e in updates.items()], F.lit(True).alias("_hit")).alias("_set"))
        old = self._scan(before, [f"{self.path}/data/{f}" for f in sorted(touched)])
        hit = F.coalesce(F.col("_set._hit"), F.lit(False))
        joined = join_per_key(old, changes, pairs, "left").withColumn("_hit", hit)
        joined = materialize(joined.select(*names, "_hit", *[F.col(f"_set.{c}").alias(f"_new_{c}") for c in updates]))

        def value(c: str) -> Column:
            return F.when(F.col("_hit"), F.col(f"_new_{c}").cast(before.schema[c].dataType)).otherwise(F.col(f"`{c}`")).alias(c) if c in updates else F.col(f"`{c}`")

        kept = joined.select(*[value(c) for c in names])
        known = joined.where("_hit").select(*[F.col(f"`{k}`").alias(f"_known_{k}") for k in keys]).distinct()
        fresh = dml.with_defaults(source.join(known, [F.col(f"`{k}`") == F.col(f"_known_{k}") for k in keys], "left_anti"), insert_defaults or {})
        if before.id_col:
            fresh = dml.assign_ids(fresh, before.id_col, [F.col(f"`{k}`") for k in keys], before.last_id)
        present = set(fresh.columns)
        fresh = materialize(fresh.select(*[(F.col(f"`{c}`") if c in present else F.lit(None)).cast(before.schema[c].dataType).alias(c) for c in names]))
        version = self._write(before, kept.unionByName(fresh), touched, token)

        image = F.struct(*[F.col(f"`{c}`") for c in names])
        changed = joined.where("_hit").select(F.lit("UPDATE").alias("action"), image.alias("old"), F.struct(*[value(c) for c in names]).alias("new"))
        added = fresh.select(F.lit("INSERT").alias("action"), F.lit(None).cast(changed.schema["old"].dataType).alias("old"), image.alias("new"))
        log = changed.unionByName(added)
        log.write.mode("overwrite").parquet(f"{self.path}/log/v={version}")
        for stored in (source, joined, fresh):
            drop_stored(stored)
        return version, self.spark.read.schema(log.schema).parquet(f"{self.path}/log/v={version}")

    def log(self, version: int) -> DataFrame:
        """The change log of the merge that made a version."""
        return self.spark.read.parquet(f"{self.path}/log/v={version}")
