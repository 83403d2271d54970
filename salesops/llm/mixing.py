"""Temperature mixing of sources, in DataFrame functions only: an exponent on token shares, then whole copies and cut block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesops.llm.packing import word_count
from salesops.operators.skew import join_per_key
from salesops.sources.storage import materialize

MAX_REPETITION = 2.0
BLOCK_ROWS = 4096  # documents of a block, on average
_CUTS = 16  # exponents tried at once


def _measures(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """{exponent: (entropy of the weights, largest over smallest repetition)}; one row per exponent is gathered."""
    tried = shares.where("p > 0").select("p", F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a"))
    raised, repeated = F.pow("p", "a"), F.pow(F.col("p"), F.col("a") - 1)
    sums = tried.groupBy("a").agg(F.sum(raised).alias("z"), F.sum(raised * F.ln("p")).alias("l"), F.max(repeated).alias("hi"), F.min(repeated).alias("lo"))
    return {r.a: (math.log(r.z) - r.a * r.l / r.z, r.hi / r.lo) for r in sums.collect()}


def best_exponent(shares: DataFrame, max_repetition: float | None, entropy: float | None) -> float:
    """The smallest exponent in [0, 1] whose repetitions stay within the limit, or the largest whose entropy reaches the target; to 1e-6.

    Entropy and repetition both fall as the exponent grows, so the interval is cut by _CUTS until it is short enough.
    """
    lo, hi = 0.0, 1.0

    def passes(m: tuple[float, float]) -> bool:  # true on the upper side of the exponent for repetition, the lower for entropy
        return m[1] <= max_repetition * (1 + 1e-9) if entropy is None else m[0] >= entropy - 1e-12

    while hi - lo > 1e-7:
        grid = [lo + (hi - lo) * i / _CUTS for i in range(_CUTS + 1)]
        found = _measures(shares, grid)
        if not found:
            return 1.0
        good = [a for a in grid if passes(found[a])]
        if not good:
            return 1.0 if entropy is None else 0.0
        if entropy is None:
            if (edge := min(good)) == 0.0:
                return 0.0
            lo, hi = edge - (hi - lo) / _CUTS, edge
        else:
            if (edge := max(good)) == 1.0:
                return 1.0
            lo, hi = edge, edge + (hi - lo) / _CUTS
    return round(hi if entropy is None else lo, 6)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens: Column | None = None,
        max_repetition: float = MAX_REPETITION, entropy: float | None = None, budget: int | None = None, seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` repeated to the mixture, with ``epoch``, ``block_rank`` and ``order_key`` in place of columns so named.

    A source's weight is its token share to the power of an exponent, normalised; ``best_exponent`` finds the flattest mixture in which no source
    is repeated more than ``max_repetition`` times as often as another, or the least flat one with the ``entropy`` (nats). Without ``budget`` (tokens in all)
    the mixture is as small as it can be with every document in it: the source that is repeated least comes once. With a budget, sources may come in part.

    A source's tokens are dealt in epochs. Its documents lie in blocks by the hash of their id, and each epoch is a permutation
    of the blocks and of each block's documents (``block_rank``, then ``order_key``). Whole epochs hold every document; the last one ends where the
    quota is spent: blocks before the cut are whole, the block at the cut gives its first documents, and no document is split, so
    a source falls short by less than one document (or copies of one id). Only sums per block meet in a window.

    A null source is one of its own. Documents without tokens come with their block; those of a source without any tokens come once. Rows
    of equal id stay together, rows without an id are one such group. An empty table gives an empty result.
    """
    if max_repetition < 1:
        raise ValueError("max_repetition must be 1 or more")
    n = word_count(F.col(text_col)) if tokens is None else tokens.cast("bigint")
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("src"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"), F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).alias("n"))
    sums = materialize(rows.groupBy("src").agg(F.sum("n").alias("t"), F.count("*").alias("docs")))
    total = sums.agg(F.sum("t").alias("t")).first().t or 0
    shares = sums.withColumn("p", F.col("t") / F.lit(float(max(total, 1))))
    exponent = best_exponent(shares, max_repetition, entropy)
    times = F.pow(F.col("p"), F.lit(exponent - 1))
    if budget is None:
        least = shares.where("p > 0").agg(F.min(times).alias("m")).first().m or 1.0
        times = times / F.lit(least)
    else:
        z = shares.where("p > 0").agg(F.sum(F.pow("p", F.lit(exponent))).alias("z")).first().z or 1.0
        times = times * F.lit(budget / float(f"{z:.12g}") / max(total, 1))
    times = F.when(F.col("p") > 0, times).otherwise(1.0)
    quota = F.when(F.col("p") > 0, F.round(times * F.col("t")).cast("bigint")).otherwise(0)
    whole = F.when(F.col("p") > 0, F.floor(F.col("quota") / F.greatest("t", F.lit(1)))).otherwise(1).cast("int")
    plan = shares.withColumn("quota", quota).withColumn("whole", whole).select(
        F.col("src").alias("_src"), "whole", (F.col("quota") - F.col("whole") * F.col("t")).alias("left"), F.ceil(F.col("docs") / block_rows).cast("int").alias("blocks")
    )
    planned = materialize(plan)

    block = F.pmod(F.xxhash64("h", F.lit(7)), F.col("blocks")).cast("int")
    narrow = join_per_key(rows.select("src", "h", "n"), planned, [("src", "_src")], "inner").select("src", "h", "n", block.alias("block"), "whole", "left")
    held = materialize(narrow.groupBy("src", "block", "whole", "left").agg(F.sum("n").alias("n")))
    epochs = held.select("*", F.explode(F.sequence(F.lit(0), F.col("whole"))).alias("epoch"))
    epochs = epochs.withColumn("mixed", F.xxhash64(F.lit(seed), "src", "block", "epoch"))
    turn = W.partitionBy("src", "epoch").orderBy("mixed", "block")
    ranked = epochs.withColumn("block_rank", F.row_number().over(turn)).withColumn("end", F.sum("n").over(turn.rowsBetween(W.unboundedPreceding, 0)))
    last = F.col("epoch") == F.col("whole")
    ranked = materialize(ranked.where(~last | ((F.col("left") > 0) & (F.col("end") - F.col("n") < F.col("left")))))
    cut = ranked.where(last & (F.col("end") > F.col("left"))).select(
        F.col("src").alias("_src"), F.col("block").alias("_block"), F.col("epoch").alias("at"), (F.col("left") - F.col("end") + F.col("n")).alias("room")
    )
    inside = narrow.select("src", "h", "n", "block").join(cut, F.col("src").eqNullSafe(F.col("_src")) & (F.col("block") == F.col("_block")))
    inside = inside.groupBy("src", "block", "at", "room", "h").agg(F.sum("n").alias("n")).withColumn("key", F.xxhash64("h", "at"))
    used = F.sum("n").over(W.partitionBy("src", "block").orderBy("key", "h").rowsBetween(W.unboundedPreceding, 0))
    fits = inside.withColumn("used", used).where("used <= room").groupBy(F.col("src").alias("_src"), F.col("block").alias("_block"), F.col("at").alias("_at")).agg(F.max("key").alias("last_key"))
    joined = ranked.join(fits, F.col("src").eqNullSafe(F.col("_src")) & (F.col("block") == F.col("_block")) & (F.col("epoch") == F.col("_at")), "left")
    cut_here = last & (F.col("end") > F.col("left"))
    turns = materialize(joined.where(~cut_here | F.col("last_key").isNotNull()).select(F.col("src").alias("_src"), F.col("block").alias("_block"), "epoch", "block_rank", "last_key"))

    blocks = planned.select("_src", "blocks")
    placed = join_per_key(rows, blocks, [("src", "_src")], "inner").select("row", "src", "h", block.alias("block"))
    dealt = join_per_key(placed, turns, [("src", "_src"), ("block", "_block")], "inner").withColumn("order_key", F.xxhash64("h", "epoch"))
    dealt = dealt.where(F.col("last_key").isNull() | (F.col("order_key") <= F.col("last_key")))
    own = ("epoch", "block_rank", "order_key")
    return dealt.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in own], *own)
