"""Toxicity: held-out accuracy, sentences found, nothing but the text in a score, odd input."""

import zlib

import numpy as np

from salesops.llm import toxicity
from salesops.llm.queries import op6_toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op6_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([p == t for t, p in held]) > 0.93


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").where(~toxicity.held_out("doc_id"))
    one = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    other = toxicity.fit(docs.withColumns({"lang": docs.source, "source": docs.lang}), labels, "doc_id", "text", "toxic")
    assert one == other and one.weights and all(isinstance(w, float) for w in one.weights.values())


def test_noisy_or_gradient_finds_the_sentence(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(400):
        parts = [" ".join(f"w{rng.integers(300)}" for _ in range(8)) for _ in range(rng.integers(1, 12))]
        bad = i % 4 == 0
        if bad:
            parts[rng.integers(len(parts))] += f" vile{'abcdefgh'[i % 8]}x person"
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, int(bad)))
    df, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    out = toxicity.score_toxicity(df, known).collect()
    for r in out:
        bad = r.doc_id % 4 == 0
        assert (r.toxicity.score >= 0.5) == bad
        assert all("vile" in r.text[s.start : s.end] for s in r.toxicity.spans) and len(r.toxicity.spans) == int(bad)


def test_odd_input(spark):
    schema = "doc_id bigint, text string, toxicity int, term string, id int"
    docs = [(1, None, 1, "x", 1), (2, "", 1, "x", 1), (None, "İ bad. word", 1, "x", 1), (3, "a " * 300_000, 1, "x", 1), (3, " . . ", None, None, None)]
    df = spark.createDataFrame(docs, schema)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id bigint, toxic int")
    out = toxicity.score_toxicity(df, labels)
    assert out.columns == ["doc_id", "text", "term", "id", "toxicity"]
    rows = out.collect()
    assert len(rows) == 5 and all(0 <= r.toxicity.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.toxicity.score < 0.5 for r in toxicity.score_toxicity(df.where("length(text) < 100"), none).collect()] == [True] * 3
    assert toxicity.score_toxicity(spark.createDataFrame([], schema), labels).count() == 0


def test_labels_of_absent_documents_take_no_place(spark):
    docs = [(i, "You are a vile horrid fool." if i % 2 else "The weather is mild today.") for i in range(40)]
    labels = [(i, i % 2) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    alone = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int"), "doc_id", "text", "toxic", max_labelled=40)
    more = spark.createDataFrame(labels + [(1000 + i, 0) for i in range(4000)], "doc_id bigint, toxic int")
    assert alone.weights and toxicity.fit(frame, more, "doc_id", "text", "toxic", max_labelled=40) == alone
