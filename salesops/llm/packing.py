"""Packing into length buckets whose boundaries a dynamic program chooses, and batches of a token budget inside each bucket."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.operators.ordered import with_position

MAX_LENGTH = 2048
BUCKETS = 12
BUDGET = 32_768  # padded tokens of a batch


def word_count(text: Column) -> Column:
    """Words of a text between blanks; the token count wherever none is given."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


class Bucket(NamedTuple):
    length: int  # padded length, the boundary
    before: int  # pieces in shorter buckets
    per_batch: int
    first_batch: int


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` boundaries (the longest length among them) under which padding every length to the next boundary
    adds least tokens. Exact, by dynamic programming over the different lengths."""
    order = np.argsort(lengths)
    at, n = np.array(lengths, np.int64)[order], np.array(counts, np.int64)[order]
    m = len(at)
    if not m:
        return []
    rows, tokens = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * at)])
    # waste[i, j]: lengths i..j padded to length j
    waste = (at[None, :] * (rows[1:][None, :] - rows[:-1][:, None]) - (tokens[1:][None, :] - tokens[:-1][:, None])).astype(np.float64)
    waste[np.tril_indices(m, -1)] = np.inf
    best, chosen = waste[0].copy(), [np.zeros(m, int)]
    for _ in range(1, min(buckets, m)):
        total = waste.copy()
        total[1:] += best[:-1, None]
        first = total.argmin(axis=0)
        best = total[first, np.arange(m)]
        chosen.append(first)
    ends, j = [], m - 1
    for first in reversed(chosen):
        ends.append(int(at[j]))
        j = first[j] - 1
        if j < 0:
            break
    return sorted(ends)


def pieces(docs: DataFrame, id_col: str, tokens: Column, max_length: int) -> DataFrame:
    """(id, piece, start, n_tokens): every text whole, cut into pieces of ``max_length`` tokens and a shorter last one."""
    counted = docs.select(F.col(id_col).cast("bigint").alias("id"), tokens.cast("bigint").alias("n")).where("n > 0")
    cut = counted.select("id", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / max_length).cast("int") - 1)).alias("piece"))
    start = F.col("piece").cast("bigint") * max_length
    return cut.select("id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(max_length)).alias("n_tokens"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None, max_length: int = MAX_LENGTH, buckets: int = BUCKETS,
         budget: int = BUDGET, seed: int = 1) -> DataFrame:
    """(id, piece, start, n_tokens, bucket, batch, slot), a row for every piece of every text.

    ``tokens`` counts a row's tokens (default: words). Texts longer than ``max_length`` are cut, none is shortened. The histogram of all
    lengths (at most ``max_length`` rows, the only thing that is gathered) gives the ``buckets`` boundaries of least padding; ``bucket`` is
    the length that a piece is padded to. Inside a bucket pieces are put into a random but fixed order, and each run of
    ``budget // bucket`` of them (one at least) is a batch. Positions are whole-table positions less the pieces of
    shorter buckets, so a bucket with most rows is no group of its own. Batches are numbered over all buckets.

    Texts without tokens (null, empty, blank) have no piece. Repeated rows are packed as often as they come; a null id is carried. Other columns are not read.
    """
    if min(max_length, buckets, budget) < 1:
        raise ValueError("max_length, buckets and budget must be positive")
    rows = pieces(docs, id_col, word_count(F.col(text_col)) if tokens is None else tokens, max_length)
    counts = {r.n_tokens: r.n for r in rows.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    plan, before, batches = [], 0, 0
    ends = best_boundaries(list(counts), list(counts.values()), buckets)
    for low, end in zip([0, *ends], ends):
        held, each = sum(n for length, n in counts.items() if low < length <= end), max(1, budget // end)
        plan.append(Bucket(end, before, each, batches))
        before, batches = before + held, batches - (-held // each)

    def of(field: str) -> Column:
        return F.coalesce(*[F.when(F.col("n_tokens") <= b.length, getattr(b, field)) for b in plan], F.lit(0)).cast("bigint")

    shuffled = F.xxhash64(F.lit(seed), "id", "piece")
    placed = with_position(rows.withColumn("bucket", of("length")).withColumn("mixed", shuffled), [F.col(c) for c in ("bucket", "mixed", "id", "piece", "start")], "at")
    inside = F.col("at") - 1 - of("before")
    batch = of("first_batch") + F.floor(inside / of("per_batch")).cast("bigint")
    slot = (inside % of("per_batch")).cast("int")
    return placed.select(F.col("id").alias(id_col), "piece", "start", "n_tokens", "bucket", batch.alias("batch"), slot.alias("slot"))
