"""Packing: boundaries against all choices, batches within their budget, nothing lost."""

import random
from collections import defaultdict
from itertools import combinations

import pytest

from salesops.llm.packing import BUDGET, MAX_LENGTH, best_boundaries, pack
from salesops.llm.queries import op2_packing


def waste(lengths, counts, ends):
    return sum(n * (min(e for e in ends if e >= length) - length) for length, n in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(30):
        lengths = rng.sample(range(1, 60), rng.randrange(1, 10))
        counts = [rng.randrange(1, 50) for _ in lengths]
        for k in (1, 2, 3, 12):
            ends = best_boundaries(lengths, counts, k)
            others = [x for x in lengths if x != max(lengths)]
            best = min(waste(lengths, counts, [*c, max(lengths)]) for c in combinations(others, min(k, len(lengths)) - 1))
            assert len(ends) <= k and max(ends) == max(lengths) and waste(lengths, counts, ends) == best
    assert best_boundaries([], [], 3) == []


def check(rows, docs, max_length, budget):
    spans, batches = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r[0]].append((r.start, r.n_tokens))
        batches[r.batch].append(r)
        assert 0 < r.n_tokens <= r.bucket <= max_length
    for i, text in docs:
        n = len(text.split()) if text else 0
        assert sorted(spans[i]) == [(s, min(max_length, n - s)) for s in range(0, n, max_length)]
    assert sorted(batches) == list(range(len(batches)))
    short = defaultdict(int)
    for rows in batches.values():
        bucket = {r.bucket for r in rows}
        assert len(bucket) == 1 and sorted(r.slot for r in rows) == list(range(len(rows)))
        each = max(1, budget // min(bucket))
        assert len(rows) <= each
        short[min(bucket)] += len(rows) < each
    assert max(short.values(), default=0) <= 1  # only a bucket's last batch is not full


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op2_packing(spark, sf).collect()
    check(rows, docs, MAX_LENGTH, BUDGET)
    counts = defaultdict(int)
    for r in rows:
        counts[r.n_tokens] += 1
    ends = best_boundaries(list(counts), list(counts.values()), 12)
    assert {r.n_tokens: r.bucket for r in rows} == {n: min(e for e in ends if e >= n) for n in counts}


def test_odd_input(spark):
    docs = [(1, "a b c"), (2, None), (3, ""), (4, " \n "), (5, "w " * 5000), (6, "one"), (7, "é ü　x")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, at int, bucket int")
    check(pack(df, max_length=100, buckets=3, budget=250).collect(), docs[:6] + [(7, "a b")], 100, 250)
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.batch, r.slot) for r in pack(twice, budget=4, buckets=2).collect()) == [(0, 0, 0), (1, 1, 0), (1, 1, 1)]
    assert pack(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    with pytest.raises(ValueError):
        pack(df, budget=0)
