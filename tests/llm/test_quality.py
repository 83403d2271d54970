"""Quality: held-out accuracy, the arithmetic of the priors against a plain version, odd input."""

import numpy as np

from salesops.llm import quality
from salesops.llm.queries import op3_quality_classifier


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    scored = quality.score_quality(docs, labels.where("doc_id % 2 = 0")).select("doc_id", "accepted").collect()
    held = [(known[r.doc_id], r.accepted) for r in scored if r.doc_id % 2 and r.doc_id in known]
    good = [a for q, a in held if q == 1]
    bad = [a for q, a in held if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.25


def test_query_scores_every_document(spark, sf):
    rows = op3_quality_classifier(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.accepted == (r.quality >= 0.5)
        assert abs(r.quality - 1 / (1 + np.exp(-(r.evidence + r.site_prior)))) < 1e-12


def test_priors(spark):
    rng = np.random.default_rng(1)
    rows = [("big", "x", 0.9)] * 400 + [("big", "y", 0.8)] * 100 + [("bad", "x", 0.1)] * 300 + [("small", "x", 0.0)] + [(None, None, 0.5)] * 3
    rows += [(f"s{i}", "x", float(rng.beta(8, 2))) for i in range(40) for _ in range(5)]
    got = {(r.site, r.section): r.prior for r in quality.site_posteriors(spark.createDataFrame(rows, "site string, section string, p double")).collect()}
    n, s = {}, {}
    for site, section, p in rows:
        n[site, section] = n.get((site, section), 0) + 1
        s[site, section] = s.get((site, section), 0) + p

    def strength(ns, rates, around):
        ns, rates, around = np.array(ns, float), np.array(rates), np.array(around)
        spread = (ns * (rates - around) ** 2).sum() - (around * (1 - around)).sum()
        variance = max(spread / max(ns.sum() - (ns**2).sum() / ns.sum(), 1e-9), 1e-9)
        return min(max((ns * around * (1 - around)).sum() / ns.sum() / variance - 1, 1.0), 1e6)

    sites = sorted({k[0] for k in n}, key=str)
    sn = [sum(v for k, v in n.items() if k[0] == x) for x in sites]
    ss = [sum(v for k, v in s.items() if k[0] == x) for x in sites]
    mean = sum(ss) / sum(sn)
    k = strength(sn, np.array(ss) / sn, [mean] * len(sn))
    parent = {x: (b + mean * k) / (a + k) for x, a, b in zip(sites, sn, ss)}
    keys = list(n)
    inner = strength([n[x] for x in keys], [s[x] / n[x] for x in keys], [parent[x[0]] for x in keys])
    for x in keys:
        expected = min(max((s[x] + parent[x[0]] * inner) / (n[x] + inner), 0.01), 0.99)
        assert abs(got[x] - expected) < 1e-9
    assert got["bad", "x"] < 0.2 < got["small", "x"]  # one document tells less than its site has in common with others


def test_odd_input(spark):
    schema = "doc_id bigint, text string, source string, lang string, row int, quality string"
    docs = [(1, None, "s", "en", 1, "q"), (2, "", None, None, 1, "q"), (None, "some words here.", "s", None, None, None), (3, "x " * 200_000, "s", "en", 1, "q"), (3, "x " * 200_000, "s", "en", 1, "q")]
    df = spark.createDataFrame(docs, schema)
    none = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id bigint, quality int")
    out = quality.score_quality(df, none)
    assert out.columns == ["doc_id", "text", "source", "lang", "row", "evidence", "site_prior", "quality", "accepted"]
    rows = out.collect()
    assert len(rows) == 5 and all(r.accepted for r in rows)
    assert quality.score_quality(spark.createDataFrame([], schema), none).count() == 0
    assert quality.score_quality(df, spark.createDataFrame([], "doc_id bigint, quality int")).count() == 5
