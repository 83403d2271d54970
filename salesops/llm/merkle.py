"""Merkle manifest of a table: one tree per group, a tree over the groups' roots, and proofs by nested intervals of leaf ranks.

Every node carries the interval of leaf ranks it covers. A node of level L lies in the bucket ``lo div 16^(L+1)`` of the level above;
within a bucket the interval that contains its own is its parent's, and the parent's children outside its own interval are its
siblings. Levels are joined from the top downwards, so that a join meets at most 16 children per parent whatever the size of a group.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.operators.ordered import with_position
from salesops.operators.skew import join_per_key
from salesops.sources.storage import materialize

FAN = 16  # children of a node
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"


class Manifest(NamedTuple):
    """``root``: the digest of everything (None for an empty table). ``nodes``: (tree, group, level, lo, hi, digest) of all inner nodes, tree
    being 'group' or 'top'. ``rows``: per row ``id``, ``group``, ``leaf``, ``subroot``, ``steps`` (its siblings' digests to the left and
    right, level by level to the root) and ``carried``."""

    root: str | None
    nodes: DataFrame
    rows: DataFrame


def field_text(value: Column) -> Column:
    """A field as it enters a leaf: '-' for null, else its UTF-8 byte count, ':' and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """The digest of all siblings, level by level to the root, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _climb(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The levels above leaves (group, n, lo, digest, payload): (group, n, lo, hi, digest, children), stored one by one.

    ``n`` is the number of leaves of the group. A group's lone leaf is lifted to level 1 as it is. A group's single node goes no further.
    """
    levels: list[DataFrame] = []
    nodes = leaves.withColumn("hi", F.col("lo") + 1)
    span = 1
    while not levels or span < most:
        child = F.struct("lo", "hi", "digest", "payload") if not levels else F.struct("lo", "hi", "digest")
        runs = nodes.where(F.col("n") > span if levels else F.lit(True)).groupBy("group", "n", F.floor(F.col("lo") / (span * FAN)).alias("bucket"))
        runs = runs.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(child)).alias("children"))
        lone = F.when(F.col("n") == 1, F.col("children")[0]["digest"])
        digest = F.coalesce(lone, F.sha2(_joined(F.col("children")), 256))
        nodes = materialize(runs.select("group", "n", "lo", "hi", digest.alias("digest"), "children"))
        levels.append(nodes)
        span *= FAN
    return levels


def _step(children: Column, lo: Column, hi: Column) -> Column:
    """The siblings: the parent's children outside an interval."""
    left, right = F.filter(children, lambda c: c["hi"] <= lo), F.filter(children, lambda c: c["lo"] >= hi)
    return F.struct(_joined(left).alias("left"), _joined(right).alias("right"))


def _descend(levels: list[DataFrame], start: DataFrame) -> DataFrame:
    """(group, n, lo, digest, payload, subroot, steps) of every leaf; ``start`` gives subroot and steps of each group's top node."""
    start = start.select(F.col("group").alias("_top_group"), "subroot", "steps")
    above: DataFrame | None = None
    for height in range(len(levels), 0, -1):
        nodes = levels[height - 1]
        whole = F.col("hi") - F.col("lo") == F.col("n")
        placed = nodes.where(whole).join(start, F.col("group") == F.col("_top_group")).drop("_top_group")
        if above is not None:
            span = FAN ** (height + 1)
            parents = above.select(F.col("group").alias("_group"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                                   F.col("children").alias("_children"), "subroot", F.col("steps").alias("_steps"))
            inside = (
                (F.col("group") == F.col("_group")) & (F.floor(F.col("lo") / span) == F.floor(F.col("_lo") / span))
                & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            )
            steps = F.concat(F.array(_step(F.col("_children"), F.col("lo"), F.col("hi"))), F.col("_steps"))
            placed = placed.unionByName(nodes.where(~whole).join(parents, inside).select(*nodes.columns, "subroot", steps.alias("steps")))
        above = placed
    leaf = above.select("group", "n", "children", "subroot", "steps", F.explode("children").alias("own"))
    own = F.when(F.col("n") == 1, F.array().cast(f"array<{_STEP}>")).otherwise(F.array(_step(F.col("children"), F.col("own.lo"), F.col("own.hi"))))
    return leaf.select("group", "n", "own.lo", "own.digest", "own.payload", "subroot", F.concat(own, F.col("steps")).alias("steps"))


def _inner(levels: list[DataFrame], tree: str) -> list[DataFrame]:
    """The nodes of a tree above its leaves; a lone leaf has none."""
    return [level.where("n > 1").select(F.lit(tree).alias("tree"), "group", F.lit(i).alias("level"), "lo", "hi", "digest") for i, level in enumerate(levels, 1)]


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "source", id_col: str = "doc_id",
          carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``carry`` are expressions over its columns that each row brings along (they must be of types that can be ordered).

    A text is hashed where it is read; what moves is one narrow row: id, group, digests. Leaves are ranked by distributed positions in the order
    (group, id with nulls first, leaf), so rows with equal ids have a defined place and equal rows may change places without effect. Each level is
    stored, a sixteenth of the one below. The driver gets two numbers and the root.

    A null group is a group of its own, before all others. A lone leaf of a group is its subroot, a lone subroot the root. Columns outside the named
    ones are not read. An empty table has no rows and the root None.
    """
    values = [F.col(f"`{f}`") for f in fields]
    carried = F.struct(*[e.alias(c) for c, e in (carry or {"nothing": F.lit(None).cast("int")}).items()])
    group = F.col(f"`{group_col}`").cast("string")
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"), group.alias("value"), F.coalesce(F.concat(F.lit("+"), group), F.lit("-")).alias("group"),
        leaf_digest(values).alias("digest"), carried.alias("carried"),
    )
    placed = materialize(with_position(narrow, [F.col("value").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest")], "position"))
    sizes = materialize(placed.groupBy(F.col("group").alias("_group")).agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("first"), F.first("value").alias("_value")))
    largest = sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("groups")).first()
    ranked = join_per_key(placed, sizes.select("_group", "n", "first"), [("group", "_group")], "inner")
    payload = F.struct("id", "value", "carried").alias("payload")
    levels = _climb(ranked.select("group", "n", (F.col("position") - F.col("first")).alias("lo"), "digest", payload), largest["n"])

    tops = [level.where(F.col("hi") - F.col("lo") == F.col("n")).select(F.col("group").alias("_top"), "digest") for level in levels]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    order = sizes.select(F.col("_group").alias("name"), "_value").join(subroots, F.col("name") == F.col("_top"))
    order = with_position(order.select("name", "_value", "digest"), [F.col("_value").asc_nulls_first()], "position")
    over = order.select(F.lit("").alias("group"), F.lit(largest["groups"]).cast("bigint").alias("n"), (F.col("position") - 1).alias("lo"), "digest",
                        F.struct("name").alias("payload"))
    crown = _climb(over, largest["groups"])
    top = crown[-1].select("digest").first()
    root = top["digest"] if top else None

    apex = crown[-1].select("group", F.col("digest").alias("subroot"), F.array().cast(f"array<{_STEP}>").alias("steps")).limit(1)
    starts = _descend(crown, apex).select(F.col("payload.name").alias("group"), F.col("digest").alias("subroot"), "steps")
    leaves = _descend(levels, materialize(starts))
    rows = leaves.select("payload.id", F.col("payload.value").alias("group"), F.col("digest").alias("leaf"), "subroot", "steps", F.col("payload.carried").alias("carried"))
    nodes = [*_inner(levels, "group"), *_inner(crown, "top")]
    both = nodes[0]
    for more in nodes[1:]:
        both = both.unionByName(more)
    return Manifest(root, both, rows)
