"""Toxicity by multiple-instance learning: sentences get scores, a noisy-or of them is fitted to document labels, and the sentences tell where."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesops.sources.storage import drop_stored, materialize

MAX_LABELLED = 20_000  # labelled documents learnt from: those with the smallest hashes of their ids
MAX_TERMS = 4096  # terms of a model
_SENTENCE = re.compile(r"[^.!?\n]+")
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_/\\"
_KEPT = 200_000  # words whose terms a task remembers


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, so that other endings of a known stem count too."""
    return [word, *[f"{word[:k]}*" for k in range(3, min(len(word), 7))]]


def sentences_of(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words) of each sentence with a word; code points, end exclusive."""
    for found in _SENTENCE.finditer(text):
        words = [w for w in (x.strip(_EDGES) for x in found[0].lower().split()) if w]
        if words:
            yield found.start(), found.end(), words


class Model(NamedTuple):
    """A sentence's log odds are ``bias`` plus the weights of its different terms."""

    weights: dict[str, float]
    bias: float


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n, t): in how many documents of a batch, and of the toxic among them, each term comes."""
    for batch in batches:
        n, t = Counter(), Counter()
        for text, toxic in zip(batch.column(0), batch.column(1)):
            found = {x for _, _, words in sentences_of(text.as_py() or "") for w in words for x in terms_of(w)}
            n.update(found)
            if toxic.as_py():
                t.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array(list(n.values()), pa.int64()), pa.array([t[x] for x in n], pa.int64())], ["term", "n", "t"])


def choose_terms(sample: DataFrame, max_terms: int) -> list[str]:
    """The terms of most significance (chi-square) among those commoner in toxic documents, of ``sample`` (text, toxic)."""
    whole = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    if not whole.t or whole.t == whole.n:
        return []
    share = whole.t / whole.n
    counted = sample.select("text", "toxic").mapInArrow(_term_counts, "term string, n bigint, t bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    more = F.col("t") - F.col("n") * share
    chi = more * more / (F.col("n") * F.lit(share * (1 - share)))
    best = counted.where(F.col("t") >= 3).withColumn("chi", chi).where((more > 0) & (F.col("chi") > 10)).orderBy(F.desc("chi"), "term").limit(max_terms)
    return [r.term for r in best.collect()]


def _bag(terms: dict[str, int]):
    @F.arrow_udf("struct<n:int,at:array<int>,term:array<int>>")
    def of(texts: pa.Array) -> pa.Array:
        """How many sentences a text has, and the (sentence, term) pairs of known terms."""
        out, known = [], {}
        for text in texts:
            at, term, n = [], [], 0
            for _, _, words in sentences_of(text.as_py() or ""):
                for x in _active(words, terms, known):
                    at.append(n)
                    term.append(x)
                n += 1
            out.append({"n": n, "at": at, "term": term})
        return pa.array(out, pa.struct([("n", pa.int32()), ("at", pa.list_(pa.int32())), ("term", pa.list_(pa.int32()))]))

    return of


def _active(words: list[str], terms: dict, known: dict) -> set:
    """The known terms of a sentence; ``known`` remembers the terms of words."""
    found: set = set()
    for w in words:
        hit = known.get(w)
        if hit is None:
            if len(known) >= _KEPT:
                known.clear()
            hit = known[w] = tuple(terms[x] for x in terms_of(w) if x in terms)
        if hit:
            found.update(hit)
    return found


def fit_noisy_or(sizes: np.ndarray, doc: np.ndarray, at: np.ndarray, term: np.ndarray, toxic: np.ndarray, terms: int, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps (Adam) on the likelihood of document labels, 1 - prod(1 - p_sentence) being a document's.

    ``sizes``: sentences per document; ``doc``, ``at``, ``term``: the known terms by document and sentence.
    """
    key, sentence = np.unique(doc.astype(np.int64) << 32 | at, return_inverse=True)
    owner = key >> 32
    plain = sizes - np.bincount(owner, minlength=len(sizes))  # sentences without a known term
    w, first, second = np.full(terms + 1, 0.1), np.zeros(terms + 1), np.zeros(terms + 1)
    w[-1] = -5.0
    for step in range(1, steps + 1):
        z = np.bincount(sentence, weights=w[term], minlength=len(key)) + w[-1]
        p, base = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-w[-1]))
        clean = np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(sizes)) + plain * np.log1p(-base)
        whole = np.clip(-np.expm1(clean), 1e-9, 1)
        pull = np.where(toxic, (1 - whole) / whole, -1.0)  # of the log likelihood, for each unit of a sentence's score
        grad = np.bincount(term, weights=(pull[owner] * p)[sentence], minlength=terms + 1)
        grad[-1] = (pull[owner] * p).sum() + (pull * plain).sum() * base
        grad = -grad / len(sizes) + 1e-5 * np.append(w[:-1], 0.0)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_col: str, max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS) -> Model:
    """Learn from at most ``max_labelled`` documents of the table with a label; labels of one id are averaged, a tie is toxic.

    The sample's ids are broadcast (their number is the bound), so no text is shuffled.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("_id"))
    here = docs.select(F.col(id_col).cast("bigint").alias("_doc")).distinct()  # labels of absent documents take no place in the sample
    known = known.agg((F.avg(toxic_col) >= 0.5).cast("int").alias("toxic")).join(here, F.col("_id") == F.col("_doc"), "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sample = materialize(texts.join(F.broadcast(known), F.col("id") == F.col("_id")).select("id", "text", "toxic"))
    terms = {x: i for i, x in enumerate(choose_terms(sample, max_terms))}
    rows = sample.select("toxic", _bag(terms)("text").alias("b")).select("toxic", "b.*").where("n > 0").collect() if terms else []
    drop_stored(sample)
    toxic = np.array([r.toxic for r in rows], bool)
    if not rows:
        return Model({}, -5.0)
    doc = np.repeat(np.arange(len(rows)), [len(r.at) for r in rows])
    at, term = (np.concatenate([np.array(getattr(r, f), np.int64) for r in rows]) for f in ("at", "term"))
    weights, bias = fit_noisy_or(np.array([r.n for r in rows]), doc, at, term, toxic, len(terms))
    return Model({x: float(weights[i]) for x, i in terms.items()}, bias)


def scorer(model: Model):
    """A column function: struct<score, spans: array<struct<start, end, score>>> of a text."""
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])
    ids = {x: i for i, x in enumerate(model.weights)}
    weights = np.array(list(model.weights.values()) or [0.0])
    bias = model.bias

    @F.arrow_udf("struct<score:double,spans:array<struct<start:int,end:int,score:double>>>")
    def of(texts: pa.Array) -> pa.Array:
        known: dict = {}
        base = float(np.log1p(np.exp(bias)))  # -log(1 - p) of a sentence without known terms
        out = []
        for text in texts:
            harm, n, spans = 0.0, 0, []
            for start, end, words in sentences_of(text.as_py() or ""):
                n += 1
                if found := _active(words, ids, known):
                    z = bias + float(sum(weights[x] for x in sorted(found)))
                    harm += float(np.logaddexp(0.0, z))
                    if z >= 0:
                        spans.append({"start": start, "end": end, "score": float(1 / (1 + np.exp(-z)))})
                else:
                    harm += base
            out.append({"score": float(-np.expm1(-(harm if n else base))), "spans": spans})
        return pa.array(out, kind)

    return of


def held_out(id_col: str, folds: int = 5) -> Column:
    """Whether a row's id is kept from learning: crc32 of the id as text is divisible by ``folds``; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
                   max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS) -> DataFrame:
    """``docs`` with ``toxicity``: struct<score, spans>, in place of a column so named.

    ``score`` is the noisy-or over the scores of all sentences; ``spans`` are the sentences that score 0.5 or more, in code points. Only the
    text enters a score. A null, empty or blank text scores as one sentence without known terms and has no spans. Without labels
    of both kinds all texts score low. Repeated rows score alike; rows without an id are scored, not learnt from.
    """
    model = fit(docs, labels, id_col, text_col, toxic_col, max_labelled, max_terms)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "toxicity"], scorer(model)(F.col(text_col)).alias("toxicity"))
