"""Fingerprints: homomorphism, likeness, the walk over all documents against a plain version, odd input."""

import hashlib
import random

from salesops.llm.fingerprint import Fingerprint, edited_fingerprints
from salesops.llm.queries import op7_fingerprints


def plain(docs):
    """{id: (n_chars, edited_sha256, fingerprint, edited, near_edited, near_next)} for different ids."""
    docs = sorted(docs, reverse=True)
    out = {}
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (Fingerprint.of(x.encode()) for x in (text, edited, following))
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(b), a.likeness(b), a.likeness(c))
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_homomorphism():
    rng = random.Random(8)
    parts = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(30))).encode() for _ in range(40)]
    whole = Fingerprint.of(b"\n".join(parts))
    mixed = list(parts)
    rng.shuffle(mixed)
    assert str(Fingerprint.of(b"\n".join(mixed))) == str(whole) and Fingerprint.of(b"\n".join(mixed)).likeness(whole) == 1.0
    some = Fingerprint()
    for p in [*parts, b"more", b"more"]:
        some.insert(p)
    assert str(some) != str(whole)
    some.delete(b"more")
    assert str(some) != str(whole)
    some.delete(b"more")
    assert str(some) == str(whole) and str(Fingerprint.parse(str(whole))) == str(whole)
    assert str(Fingerprint.of(b"a\na")) != str(Fingerprint.of(b"a")) != str(Fingerprint.of(b""))


def test_likeness_follows_what_is_shared():
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]

    def like(n):
        other = words[:n] + [f"v{rng.randrange(10**6)}" for _ in range(2000 - n)]
        return Fingerprint.of(" ".join(words).encode()).likeness(Fingerprint.of(" ".join(other).encode()))

    assert like(1990) > 0.9 > like(1400) > 0.5 > like(600) > like(0) - 0.1 and like(0) < 0.4


def test_query_equals_plain_version(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found, expected = got(op7_fingerprints(spark, sf)), plain(docs)
    assert found == expected
    halves = [v for v in expected.values() if v[0] > 500]
    assert sum(v[4] > v[5] for v in halves) > 0.95 * len(halves)


def test_odd_input(spark):
    docs = [(5, None), (9, ""), (7, "\n\n"), (-3, "é" * 7), (2**60, "x"), (1, "long " * 100_000)]
    schema = "doc_id bigint, text string"
    df = spark.createDataFrame([(*d, 1, "h") for d in docs], schema + ", bucket int, h string")
    assert got(edited_fingerprints(df)) == plain(docs)
    assert got(edited_fingerprints(spark.createDataFrame([(1, "abc")], schema))) == plain([(1, "abc")])
    rows = edited_fingerprints(spark.createDataFrame([(1, "abcd"), (1, "abcd"), (None, "q"), (None, None), (1, "zz")], schema)).collect()
    assert len(rows) == 5 and sorted(r.n_chars for r in rows) == [0, 1, 2, 4, 4]
    assert edited_fingerprints(spark.createDataFrame([], schema)).count() == 0
