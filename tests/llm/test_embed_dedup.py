"""Sorted projection passes against brute force, a large group and odd input."""

import numpy as np

import pytest

from salesops.llm.embed_dedup import near_vectors, plan_passes
from salesops.llm.queries import op4_embedding_near_dedup
from tests.llm.brute import classes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def exact(rows, cosine=0.93):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    group = classes(ids.tolist(), [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))])
    return {i: (int(n), group[i]) for i, n in zip(ids.tolist(), linked.sum(axis=1))}


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in op4_embedding_near_dedup(spark, sf).collect()}
    assert got == exact(rows)


@pytest.mark.parametrize("sizes", [{}, {"run": 64, "crowd": 300}, {"run": 4096, "crowd": 200}])
def test_a_group_larger_than_window_and_block(spark, sizes):
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.03 * rng.standard_normal(16)).astype("float32").tolist(), 1) for i in range(1500)]
    rows += [(2000 + i, rng.standard_normal(16).astype("float32").tolist(), i % 2) for i in range(300)]
    rows += [(5000 + i, rows[1700][1], rows[1700][2]) for i in range(40)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, SCHEMA), **sizes).collect()}
    assert got == exact(rows)


def test_odd_input(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(1, v, 1), (2, w, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 3.0], 1), (8, [1.0, float("nan"), 3.0], 1),
            (9, [1.0, float("inf"), 3.0], 1), (10, [], 1), (11, [1.0, 2.0], 1), (12, v, 1), (12, v, 1), (None, v, 1), (13, [3e38, 3e38, 0.0], 3), (14, [1e-40, 1e-40, 0.0], 3),
            (5, None, 1), (15, None, None)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA + ", position int, class string")
    out = near_vectors(df).collect()
    assert len(out) == len(rows)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out if r.vec_id is not None)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 5, 6, 7, 8, 9, 10, 11, 15)]
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (12, 3, 1, False), (12, 3, 1, False), (13, 1, 13, True), (14, 1, 13, False), *alone])
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, True)]
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pairs_at_the_threshold_without_the_window(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        x, y = rng.standard_normal((2, 64))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        cosine = 0.9301 if i % 4 else rng.uniform(0.9301, 0.95)
        other = cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y)
        rows += [(2 * i, x.astype("float32").tolist(), 1), (2 * i + 1, other.astype("float32").tolist(), 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, SCHEMA), window=1, run=4).collect()}
    assert got == exact(rows)


def test_passes_keep_the_recall_while_runs_stay_short():
    meet = 1 - np.arccos(0.93) / np.pi
    for largest in (0, 1, 1024, 5000, 10**6, 10**8):
        bits, passes = plan_passes(largest, 0.93)
        assert largest / 2**bits <= 1024 and (1 - meet**bits) ** passes <= 5e-5
    assert plan_passes(1024, 0.93) == (0, 1)
