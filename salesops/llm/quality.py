"""Quality by hierarchical empirical Bayes: a document's classifier evidence on top of the posterior of its site and section."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops.operators.skew import join_per_key
from salesops.sources.storage import materialize

MAX_LABELLED = 50_000  # labelled documents that the classifier is fitted on: those with the smallest hashes of their ids
FEATURES = ("size", "upper", "symbols", "digits", "marks", "distinct", "commonest", "word_length", "bare", "ends")
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?")
_UPPER, _DIGITS, _MARKS = bytes(range(65, 91)), bytes(range(48, 58)), b"!?"


def _features(text: bytes | None) -> list[float]:
    """Shares and lengths of one text, each bounded; all zero without words."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), sum(map(len, words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1

    def share(of: bytes) -> float:
        return (len(text) - len(text.translate(None, of))) / chars

    bare = sum(c for w, c in counts.items() if not w.strip(_SYMBOLS)) / n
    ends = min(1.0, text.count(b". ") / n * 5)
    # a text of n words repeats some anyway: the number of different words is compared with a power of n
    return [np.log1p(n) / 10, share(_UPPER), share(_SYMBOLS), share(_DIGITS), share(_MARKS), len(counts) / n**0.85, max(counts.values()) / n,
            min(chars / n, 30) / 10, bare, ends]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def text_features(texts: pa.Array) -> pa.Array:
    return pa.array([_features(t.as_py()) for t in texts], pa.list_(pa.float64()))


class Classifier(NamedTuple):
    """Log odds of good quality: ``bias`` plus ``weights`` on the features; ``prior`` are the log odds of the sample."""

    weights: tuple[float, ...]
    bias: float
    prior: float

    def log_odds(self, features: Column) -> Column:
        return sum((features[i] * w for i, w in enumerate(self.weights)), F.lit(self.bias))


def _log_odds(p: Column) -> Column:
    return F.ln(p) - F.ln(1 - p)


def fit(features: DataFrame, labels: DataFrame, id_col: str, quality_col: str, max_labelled: int = MAX_LABELLED) -> Classifier:
    """Logistic regression on at most ``max_labelled`` documents (``features``: id, f). Without labels of both kinds it says nothing.

    Labels of one id are averaged; a tie is bad. Null ids and labels count for nothing.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("bigint").alias("_id")).agg((F.avg(quality_col) > 0.5).cast("int").alias("good"))
    rows = features.join(known, F.col("id") == F.col("_id")).select("f", "good", F.xxhash64("id").alias("h")).orderBy("h").limit(max_labelled).collect()
    good = np.array([r.good for r in rows], float)
    if not 0 < good.sum() < len(good):
        return Classifier((0.0,) * len(FEATURES), 0.0, 0.0)
    x = np.array([r.f for r in rows])
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w, ridge = np.zeros(z.shape[1]), np.diag([0.0] + [1.0] * len(FEATURES))
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, z.T @ (good - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    share = good.mean()
    weights = w[1:] / spread
    return Classifier(tuple(weights.tolist()), float(w[0] - weights @ mean), float(np.log(share / (1 - share))))


def _strength(groups: DataFrame, around: Column) -> Column:
    """How many documents a prior weighs, by moments: the spread of the groups' shares beyond what chance alone gives."""
    n, rate = F.col("n"), F.col("s") / F.col("n")
    within = F.sum(around * (1 - around))
    spread = F.sum(n * (rate - around) ** 2) - within
    size = F.sum(n) - F.sum(n * n) / F.sum(n)
    variance = F.greatest(spread / F.greatest(size, F.lit(1e-9)), F.lit(1e-9))
    mean = F.sum(n * around * (1 - around)) / F.sum(n)
    return F.least(F.greatest(mean / variance - 1, F.lit(1.0)), F.lit(1e6))


def site_posteriors(scores: DataFrame) -> DataFrame:
    """(site, section, prior): the expected share of good documents of each section, from ``scores`` (site, section, p).

    Soft counts are summed per section, then per site and over all. A site's share is drawn to the global one, a section's to its site's, by
    weights estimated from the spread between them, so that sparse ones hardly differ from their parent.
    """
    sections = materialize(scores.groupBy("site", "section").agg(F.count("*").cast("double").alias("n"), F.sum("p").alias("s")))
    sites = sections.groupBy("site").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = sections.agg((F.sum("s") / F.sum("n")).alias("mean")).first()
    mean = F.lit(min(max(whole.mean or 0.5, 0.01), 0.99))
    weight = sites.agg(_strength(sites, mean).alias("k")).first().k or 1.0
    sites = sites.select(F.col("site").alias("_site"), ((F.col("s") + mean * weight) / (F.col("n") + weight)).alias("parent"))
    under = join_per_key(sections, sites, [("site", "_site")], "inner")
    inner = under.agg(_strength(under, F.col("parent")).alias("k")).first().k or 1.0
    share = (F.col("s") + F.col("parent") * inner) / (F.col("n") + inner)
    return materialize(under.select("site", "section", F.least(F.greatest(share, F.lit(0.01)), F.lit(0.99)).alias("prior")))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", section_col: str = "lang",
                  quality_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` with ``evidence``, ``site_prior`` (log odds), ``quality`` (0 to 1) and ``accepted`` (quality >= 0.5) in place of columns so named.

    ``evidence`` is what the text says: log odds of the classifier less those of its sample. ``site_prior`` is the log odds
    of the share of good documents in the row's site (host) and section (path), from the classifier's scores of all documents.

    Null and empty texts have no evidence, their site decides. Null sites and sections are ones of their own. Rows without an id and
    repeated rows are scored like others. Without labels of both kinds every row has quality 0.5 or more and is accepted.
    """
    f = text_features(F.col(text_col).cast("binary"))
    read = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(site_col).cast("string").alias("site"), F.col(section_col).cast("string").alias("section"), f.alias("f"))
    features = materialize(read)
    model = fit(features, labels, id_col, quality_col, max_labelled)
    words = F.col("f")[0] > 0
    shown = features.select("site", "section", (1 / (1 + F.exp(-F.when(words, model.log_odds(F.col("f"))).otherwise(model.prior)))).alias("p"))
    priors = site_posteriors(shown).select(F.col("site").alias("_site"), F.col("section").alias("_section"), "prior")
    rows = docs.select(F.struct("*").alias("row"), F.col(site_col).cast("string").alias("site"), F.col(section_col).cast("string").alias("section"), f.alias("f"))
    joined = join_per_key(rows, priors, [("site", "_site"), ("section", "_section")], "left")
    evidence = F.when(words, model.log_odds(F.col("f")) - model.prior).otherwise(0.0)
    made = joined.select("row", evidence.alias("evidence"), _log_odds(F.coalesce("prior", F.lit(0.5))).alias("site_prior"))
    quality = 1 / (1 + F.exp(-(F.col("evidence") + F.col("site_prior"))))
    own = ("evidence", "site_prior", "quality", "accepted")
    return made.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in own], "evidence", "site_prior", quality.alias("quality"), (quality >= 0.5).alias("accepted"))
