"""Mixing: exponent, quotas and permutations against plain arithmetic, odd input."""

import math
from collections import Counter, defaultdict

import pytest

from salesops.llm.mixing import mix
from salesops.llm.queries import op10_mixing


def plan(tokens, repetition):
    """{source: copies of each token} of the flattest mixture within the limit."""
    hi, lo = max(tokens.values()), min(tokens.values())
    exponent = 1.0 if hi == lo else max(0.0, 1 - math.log(repetition) / math.log(hi / lo))
    exponent = math.ceil(round(exponent * 1e6, 3)) / 1e6 if 0 < exponent < 1 else exponent
    times = {s: t ** (exponent - 1) for s, t in tokens.items()}
    return {s: x / min(times.values()) for s, x in times.items()}, exponent


def check(rows, docs, times, tolerance=2e-5):
    size = {i: len((t or "").split()) for i, t, _ in docs}
    src = {i: s for i, _, s in docs}
    tokens = Counter()
    for i, _, s in docs:
        tokens[s] += size[i]
    copies, used, longest = Counter(), Counter(), Counter()
    order = defaultdict(list)
    for r in rows:
        assert r.source == src[r.doc_id]
        copies[r.doc_id] += 1
        used[r.source] += size[r.doc_id]
        order[r.source, r.epoch].append((r.block_rank, r.order_key, r.doc_id))
    for i in size:
        longest[src[i]] = max(longest[src[i]], size[i])
        assert math.floor(times[src[i]] * (1 - tolerance)) <= copies[i] <= math.floor(times[src[i]] * (1 + tolerance)) + 1
    for s, t in tokens.items():
        assert t * times[s] * (1 - tolerance) - longest[s] - 1 <= used[s] <= t * times[s] * (1 + tolerance) + 1
    for placed in order.values():
        assert len({x[2] for x in placed}) == len(placed)  # no document twice in an epoch
    return order


def test_query(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    tokens = Counter()
    for _, t, s in docs:
        tokens[s] += len(t.split())
    rows = op10_mixing(spark, sf).collect()
    times, exponent = plan(tokens, 2.0)
    assert 0 <= exponent < 1 and max(times.values()) <= 2.00001
    check(rows, docs, times)
    assert {r.doc_id for r in rows} == {d[0] for d in docs}


def made(sizes):
    docs = []
    for s, (n, words) in sizes.items():
        docs += [(len(docs) + k, " ".join(["w"] * (words + k % 7)), s) for k in range(n)]
    return docs


SCHEMA = "doc_id bigint, text string, source string"


def test_blocks_entropy_and_budget(spark):
    docs = made({"hot": (900, 20), "mid": (200, 15), "low": (40, 5), None: (60, 10)})
    df = spark.createDataFrame(docs, SCHEMA)
    tokens = Counter()
    for _, t, s in docs:
        tokens[s] += len(t.split())
    order = check(mix(df, max_repetition=3.0, block_rows=50).collect(), docs, plan(tokens, 3.0)[0])
    assert sorted(x[0] for x in order["hot", 0])[-1] > 10 and order["low", 0] != order["low", 1]
    total = sum(tokens.values())
    p = {s: t / total for s, t in tokens.items()}
    target = 1.2
    rows = mix(df, entropy=target, budget=10_000, block_rows=50).collect()
    used = Counter()
    for r in rows:
        used[r.source] += len(r.text.split())
    n = sum(used.values())
    assert abs(n - 10_000) < 120
    assert abs(-sum(u / n * math.log(u / n) for u in used.values()) - target) < 0.01
    assert used["hot"] / n < p["hot"] and used["low"] / n > p["low"]
    flat = mix(df, max_repetition=1.0).collect()
    assert Counter(r.doc_id for r in flat) == Counter(d[0] for d in docs)


def test_odd_input(spark):
    docs = [(1, None, "empty"), (2, "", "empty"), (3, "a b c", "x"), (4, None, "x"), (None, "one two", None), (None, "one two", None), (3, "a b c", "x"), (5, "w " * 50_000, "long")]
    df = spark.createDataFrame([(*d, 1, "r") for d in docs], SCHEMA + ", src int, row string")
    out = mix(df)
    assert out.columns == ["doc_id", "text", "source", "src", "row", "epoch", "block_rank", "order_key"]
    seen = Counter((r.doc_id, r.source) for r in out.collect())
    assert set(seen) == {(d[0], d[2]) for d in docs} and seen[1, "empty"] == 1 and seen[5, "long"] == 1 and seen[3, "x"] >= 2
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        mix(df, max_repetition=0.5)


def test_native_only(spark, sf):
    plan_text = op10_mixing(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan_text and "Arrow" not in plan_text
