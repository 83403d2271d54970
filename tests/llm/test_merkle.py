"""The Merkle manifest against a plain version; proofs, tampering, odd input."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from salesops.llm.merkle import FIELDS, build, fold, proof_digest
from salesops.llm.queries import manifest_rows, op13_merkle_manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf_of(row, text):
    return H(*(field(x) for x in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def climb(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        under = levels[-1]
        levels.append([H(*under[i : i + 16]) for i in range(0, len(under), 16)])
    return levels


def siblings(levels, at):
    """(left, right) per level of the leaf at a place."""
    out = []
    for level in levels[:-1]:
        run = at // 16 * 16
        out.append((level[run:at], level[at + 1 : run + 16]))
        at //= 16
    return out


def plain(rows):
    """The contract's rows by lists."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees[s] = climb([leaf_of(r, r["text"]) for r in groups[s]])
    top = climb([trees[s][-1][0] for s in names])
    for place, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, place)
            text = r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest = leaf_of(r, text)
            for left, right in path:
                digest = H(*left, digest, *right)
            proof = H(*(d for left, right in path for d in left + right))
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out, key=repr)


def values(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def test_query_equals_plain_version(spark, sf):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = plain(rows)
    assert values(op13_merkle_manifest(spark, sf)) == expected
    assert 0 < sum(not r[-1] for r in expected) < len(expected) / 4


def made(spark, counts, seed=0):
    rows = [(i * 7 % 100003 + seed, f"Text {i} É", None if i % 11 == 0 else "en", s, i) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]
    return spark.createDataFrame(rows, SCHEMA), [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]


@pytest.mark.parametrize("counts", [
    {"a": 1}, {"a": 16}, {"a": 17}, {None: 1, "": 2}, {"a": 257, "b": 256, None: 15, "ü": 1, "Z": 33}, {"hot": 4100, "x": 3}, {f"s{i}": 1 + i % 3 for i in range(300)},
])
def test_shapes(spark, counts):
    df, rows = made(spark, counts)
    assert values(manifest_rows(df)) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", "", 0), (1, "B", "x", "", 1), (1, "A", "x", "", 1), (-5, "long Text " * 50_000, "x", "a\u0000b", -1),
            (2, "dup", "x", "s", 3), (2, "dup", "x", "s", 3)]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA + ", digest string, steps int")
    assert values(manifest_rows(df)) == plain([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])


def test_empty_table(spark):
    empty = build(spark.createDataFrame([], SCHEMA))
    assert empty.root is None and empty.rows.count() == 0 and empty.nodes.count() == 0
    assert manifest_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nodes_are_nested_and_sound(spark):
    df, rows = made(spark, {"a": 600, "b": 20, "c": 1})
    tree = build(df, FIELDS)
    nodes = tree.nodes.collect()
    assert [n.digest for n in nodes if n.tree == "top" and n.level == 1] == [tree.root]
    for name, n in (("+a", 600), ("+b", 20)):
        for level in range(1, 4 if n > 256 else 3):
            spans = sorted((x.lo, x.hi) for x in nodes if x.tree == "group" and x.group == name and x.level == level)
            assert spans == [(lo, min(lo + 16**level, n)) for lo in range(0, n, 16**level)]
    one = tree.rows.select("leaf", fold(F.col("leaf"), F.col("steps")).alias("root"), proof_digest(F.col("steps")).alias("proof")).collect()
    assert {r.root for r in one} == {tree.root} and len({r.proof for r in one}) == len(one)


def test_a_change_anywhere_changes_the_root(spark):
    df, _ = made(spark, {"a": 40, "b": 3})
    before = build(df).root
    for c, e in {"text": F.lit("q"), "lang": F.lit("zz"), "n_chars": F.lit(-1)}.items():
        assert build(df.withColumn(c, F.when(F.col("n_chars") == 17, e).otherwise(F.col(c)))).root != before
    assert build(df.repartition(7)).root == before
