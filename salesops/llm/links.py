"""Graphs of linked rows: connected components, and links inside buckets of rows that share a key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.operators.skew import join_per_key
from salesops.sources.storage import drop_stored, materialize, release


def _star(edges: DataFrame, low_edges: DataFrame, own: bool) -> DataFrame:
    """One round over ``edges`` (u, v): u's neighbours are linked to the smallest node that ``low_edges`` has around u.

    ``own``: large star, which moves the neighbours above u; else small star, for edges with v below u. ``moved`` tells
    which edges changed. Each edge gives one edge, so their number never grows.
    """
    low = low_edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    low = low.select("k", F.least("k", "m").alias("m") if own else "m")
    rows = join_per_key(edges, low, [("u", "k")], "inner")
    end = F.col("v") if own else F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    moved = F.col("m") != F.col("u" if own else "v")
    return materialize(rows.select(end.alias("u"), F.col("m").alias("v"), moved.alias("moved")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b); component is its smallest reachable node.

    Alternating large-star and small-star rounds: each links a node's neighbours to the smallest node around, so the
    number of rounds grows with the logarithm of a component's size and the edges never outnumber the first table's.
    Each is a partial aggregate and a join that AQE may split (a component may hold most nodes), and is
    stored. Self-links and nulls count for nothing; no edges give no rows.
    """
    now = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    busy = not now.isEmpty()
    while busy:
        both = now.select("u", "v").union(now.select("v", "u"))
        large = _star(now.select(F.col("v").alias("u"), F.col("u").alias("v")), both, True)
        small = _star(large, large, False)
        busy = not large.select("moved").union(small.select("moved")).where("moved").isEmpty()
        drop_stored(now)
        drop_stored(large)
        now = small.drop("moved")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v"))
    return nodes.distinct()


def with_component(df: DataFrame, id_col: str, parts: DataFrame, name: str = "component_id") -> DataFrame:
    """``df`` with the component of its id from ``parts`` (node, component); rows without a link are their own."""
    joined = df.join(parts.select(F.col("node").alias("_linked"), F.col("component").alias("_component")), F.col(id_col) == F.col("_linked"), "left")
    return joined.withColumn(name, F.coalesce("_component", id_col)).drop("_linked", "_component")


SMALL_BUCKET = 32  # rows of a bucket up to which its pairs are formed
KEY_PARTS = 4  # in which a stored table of keys is shuffled, one after another


def _shared(keys: DataFrame) -> DataFrame:
    """(key, id, n) of the keys that several rows have, stored."""
    sizes = keys.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("n")).where("n > 1")
    return materialize(join_per_key(keys, sizes, [("key", "_key")], "inner").select("key", "id", "n"))


def _shared_by_parts(keys: DataFrame) -> list[DataFrame]:
    """The tables of ``_shared``, by parts of the keys' hash range: keys are made and stored once, and one part's shuffles are freed before the next."""
    stored = materialize(keys)
    parts = []
    for part in range(KEY_PARTS):
        parts.append(_shared(stored.where(F.pmod("key", F.lit(KEY_PARTS)) == part)))
        release(keys.sparkSession)
    drop_stored(stored)
    return parts


def _by_parts(tables: list[DataFrame], make: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """What ``make`` gives for each of the tables, stored; one's shuffles are freed before the next."""
    made = []
    for table in tables:
        made.append(materialize(make(table)))
        release(table.sparkSession)
    return made


def bucket_links(keys: DataFrame | list[DataFrame], items: DataFrame, near: Callable[[str, str], Column], verify: Callable[[DataFrame], DataFrame],
                 more: DataFrame, crowd_links: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, component) over ``more`` (edges a, b) and all verified links between rows that share a bucket.

    ``keys`` has (key, id), or is a list of such tables with different keys, which are then stored and reduced to the shared ones part by
    part, each freeing its shuffles before the next; ``items`` one row per id with what ``near`` compares; ``near(left, right)`` is a
    cheap necessary condition on the columns of two aliased items; ``verify`` takes pairs (a, b) and returns the true ones as a
    stored table.

    A bucket's pairs are never all formed. First each row is paired with its bucket's most central row, the one whose
    buckets hold most rows; true pairs are joined to components. Only a bucket whose other rows still are of several components is looked at
    again, and there only pairs of different components matter. No component is lost: a pair left out is connected already.
    In buckets of up to SMALL_BUCKET rows those pairs are formed, filtered inside the join. Larger ones may hold very many pairs that are
    nearly links; ``crowd_links``, where given, takes their rows (cluster, id, part), a cluster being what such buckets join, and returns the
    true links between different parts without forming pairs as rows. Counts come before the rows (partial aggregates), and the joins
    can be split.
    """
    kinds = [_shared_by_parts(kind) for kind in keys] if isinstance(keys, list) else [[_shared(keys)]]
    groups = [reduce(DataFrame.unionByName, part) for part in zip(*kinds)]  # each bucket is whole in one
    weight = materialize(reduce(DataFrame.unionByName, groups).groupBy(F.col("id").alias("_id")).agg(F.sum("n").alias("w")))

    def led(shared: DataFrame) -> DataFrame:
        placed = shared.join(weight, F.col("id") == F.col("_id")).select("key", "id", "n", F.struct("w", (-F.col("id")).alias("minus")).alias("rank"))
        lead = placed.groupBy(F.col("key").alias("_key")).agg((-F.max("rank")["minus"]).alias("lead"))
        return join_per_key(placed.select("key", "id", "n"), lead, [("key", "_key")], "inner").where("id != lead").select("key", "id", "n", "lead")

    buckets = _by_parts(groups, led)
    for part in [weight, *[part for kind in kinds for part in kind]]:
        drop_stored(part)
    others = reduce(DataFrame.unionByName, buckets)
    star = materialize(others.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct())
    release(items.sparkSession)
    first = verify(_near(star, items, near))
    parts = materialize(components(first))

    def undecided(others: DataFrame) -> DataFrame:
        # the most central row has met all others: nothing is left of a bucket of two
        labelled = with_component(others.where("n > 2").select("key", "id"), "id", parts, "part")
        mixed = labelled.groupBy(F.col("key").alias("_key")).agg(
            F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n"), F.min("id").alias("head")
        ).where("lo < hi").drop("lo", "hi")
        return join_per_key(labelled, mixed, [("key", "_key")], "inner").select("key", "id", "part", "n", "head")

    rests = _by_parts(buckets, undecided)
    for part in buckets:
        drop_stored(part)
    rest = reduce(DataFrame.unionByName, rests)

    def crossing(some: DataFrame) -> DataFrame:
        values = some.select("key", "id", "part").join(items, "id")
        pairs = values.alias("l").join(values.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.part") < F.col("r.part")) & near("l", "r"))
        return pairs.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct()

    used, late = [star, first, parts, *rests], more
    small = [part.where(F.col("n") <= SMALL_BUCKET) if crowd_links else part for part in rests]
    if not reduce(DataFrame.unionByName, small).isEmpty():
        for met in _by_parts(small, crossing):  # verified apart, as pairs of large rows take far more room than the buckets
            used += [met, verify(met.join(star, ["a", "b"], "left_anti"))]
            late = late.union(used[-1])
    crowd = rest.where(F.col("n") > SMALL_BUCKET)
    if crowd_links and not crowd.isEmpty():
        # a row's buckets are joined by their heads: each head to the row's least one, not each to the row
        least = crowd.groupBy(F.col("id").alias("_id")).agg(F.min("head").alias("least"))
        heads = crowd.join(least, F.col("id") == F.col("_id")).select(F.col("head").alias("a"), F.col("least").alias("b")).distinct()
        clusters = components(heads.union(least.select("_id", "least")))
        members = with_component(crowd.select("id", "part").distinct(), "id", clusters, "cluster")
        used.append(materialize(crowd_links(members.select("cluster", "id", "part"))))
        late = late.union(used[-1])
    if not late.isEmpty():
        parts = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(late))
    else:
        used.remove(parts)
    for table in used:
        drop_stored(table)
    return parts


def _near(pairs: DataFrame, items: DataFrame, near: Callable[[str, str], Column]) -> DataFrame:
    left, right = items.alias("l"), items.alias("r")
    joined = pairs.join(left, F.col("a") == F.col("l.id")).join(right, F.col("b") == F.col("r.id"))
    return joined.where(near("l", "r")).select("a", "b")
