"""Repeated passages against brute force, planted passages and odd input."""

import random
import re

from salesops.llm.queries import op5_repeated_passages
from salesops.llm.suffix_dedup import repeated_passages


def expected(docs, size):
    """{(id, start, end, first word, words)} of the stretches covered by runs of ``size`` words that stand elsewhere."""
    words = {i: [(m.start(), m.end(), re.sub("[A-Z]", lambda x: x[0].lower(), m[0])) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for i, t in docs}
    places = {}
    for i, found in words.items():
        for p in range(len(found) - size + 1):
            places.setdefault(tuple(w for _, _, w in found[p : p + size]), []).append((i, p))
    hit = {}
    for at in places.values():
        if len(at) > 1:
            for i, p in at:
                hit.setdefault(i, set()).add(p)
    out = set()
    for i, starts in hit.items():
        stretches = []
        for p in sorted(starts):
            if stretches and p <= stretches[-1][1]:
                stretches[-1][1] = p + size
            else:
                stretches.append([p, p + size])
        out |= {(i, words[i][a][0], words[i][b - 1][1], a, b - a) for a, b in stretches}
    return out


def got(df):
    return {(r[0], r.start, r.end, r.first_word, r.n_words) for r in df.collect()}


def test_query_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op5_repeated_passages(spark, sf)) == expected(docs, 51)


def test_planted_passages(spark):
    rng = random.Random(6)

    def fresh(n):
        return [f"é{rng.randrange(10**9)}" for _ in range(n)]

    shared = [fresh(n) for n in (50, 51, 52, 80, 300)]
    docs = []
    for i in range(60):
        parts = [fresh(rng.randrange(0, 90))]
        for s in rng.sample(shared, rng.randrange(0, 3)):
            parts += [s[: rng.randrange(45, len(s) + 1)] if rng.random() < 0.3 else s, fresh(rng.randrange(0, 60))]
        docs.append((i, "\n ".join(" ".join(p) for p in parts)))
    docs += [(100, " ".join(shared[3] + fresh(5) + shared[3])), (101, " ".join(["same"] * 400)), (102, " ".join(["same"] * 60))]
    found = got(repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string")))
    assert found == expected(docs, 51) and len(found) > 30


def test_odd_input(spark):
    text = "  " + " ".join(f"w{i}" for i in range(60)) + " \n"
    docs = [(1, None), (2, ""), (3, "short"), (4, text), (5, text), (5, text), (None, text), (6, " ".join(f"u{i}" for i in range(200_000)))]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id bigint, text string, pos int, h int, text_key string")
    assert got(repeated_passages(df)) == {(4, 2, len(text) - 2, 0, 60), (5, 2, len(text) - 2, 0, 60)}
    assert repeated_passages(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
