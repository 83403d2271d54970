"""Alignment of two tokenizers' tokens over a corpus; every different text is tokenised and aligned once.

Texts are shuffled whole, so copies meet; a text's token pairs count as often as the text stands in the corpus, and the measures of
a text are joined back to all its documents.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from salesops.operators.skew import join_per_key
from salesops.sources.storage import drop_stored, materialize

BLANK = "▁"  # fixed value: stands for a blank in pieces
CHUNK = 1 << 21  # bytes of text that are tokenised at once
_SECOND = 32  # bits of a pair's second id


def _byte_alphabet() -> dict[str, int]:
    """The sign of each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the others follow from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligned(NamedTuple):
    """What one text gives: token counts, groups as they are hashed, and its linked id pairs with the times each is linked."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: bytes
    pairs: np.ndarray
    times: np.ndarray


NOTHING = Aligned(0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64))


class Aligner:
    """Two tokenizers with the bytes of each token: a byte-level one (A) and one of pieces (B)."""

    def __init__(self, byte_level: bytes, piece_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_model)
        if self.a.normalizer is not None:
            raise ValueError("the byte-level tokenizer must not normalise")
        alphabet = _byte_alphabet()
        spec = json.loads(byte_level)
        names = {i: p for p, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        special = {t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_a = [b"" if i not in names else names[i].encode() if i in special else bytes(alphabet[c] for c in names[i]) for i in range(max(names) + 1)]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode())
        self.width_a, self.width_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # each id with the sign that follows it: inside its side of a group, or at its end
        na, nb = len(self.bytes_a), len(self.bytes_b)
        self.words = [f"{i}{c}".encode() for n, signs in ((na, ",|"), (nb, ",;")) for c in signs for i in range(n)]
        self.base_a, self.base_b = (0, na), (2 * na, 2 * na + nb)

    def _one(self, data: bytes, a: list[int], b: list[int]) -> Aligned:
        if b"".join(map(self.bytes_b.__getitem__, b)) != data:
            return NOTHING
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b])
        if ends_a[-1] != len(data):  # A has no normaliser: its tokens are the text's bytes in order, and can only lack some
            return NOTHING
        # no token is empty, so an end belongs to one token of each side
        _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[at_a] = last_b[at_b] = True
        sizes_a, sizes_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        place_a = np.arange(len(a)) + np.repeat(at_b + 1 - sizes_b, sizes_a)
        place_b = np.arange(len(b)) + np.repeat(at_a + 1, sizes_b)
        word = np.empty(len(a) + len(b), np.int64)
        word[place_a] = ids_a + np.where(last_a, self.base_a[1], self.base_a[0])
        word[place_b] = ids_b + np.where(last_b, self.base_b[1], self.base_b[0])
        groups = b"".join(map(self.words.__getitem__, word.tolist()))[:-1]
        pairs, times = np.unique(ids_a[at_a] << _SECOND | ids_b[at_b], return_counts=True)
        return Aligned(len(a), len(b), len(at_a), len(at_a), groups, pairs, times)

    def align(self, texts: list[str]) -> list[Aligned]:
        """A blank and each text by A, each text by B (which puts a blank before it). An empty text has no tokens."""
        spaced = [f" {t}" for t in texts]
        first = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        second = self.b.encode(texts, num_threads=1)
        return [self._one(s.encode(), x.ids, y) if t else NOTHING for t, s, x, y in zip(texts, spaced, first, second)]


@lru_cache(maxsize=2)
def aligner(byte_level: bytes, piece_model: bytes) -> Aligner:
    """The tokenizers of two files, made once in each worker."""
    return Aligner(byte_level, piece_model)


_MEASURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_OUT = f"key binary, weight bigint, {_MEASURES}, pairs array<bigint>, times array<bigint>"


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int64)))


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of about ``CHUNK`` bytes."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > CHUNK:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def text_key(text: str) -> Column:
    """What stands for a text when measures are joined: its sha256 as 32 bytes."""
    return F.unhex(F.sha2(F.col(f"`{text}`").cast("binary"), 256))


def align_distinct(docs: DataFrame, byte_level_path: str, piece_path: str, text_col: str = "text") -> DataFrame:
    """One row per different text with tokens or without: its key, number of documents, measures, and linked pairs with their times.

    Texts are counted before and after the one shuffle, so a text that a third of the rows carry costs one row per map task. A pair is
    ``id_a * 2^32 + id_b``. Null and empty texts are left out.
    """
    with open(byte_level_path, "rb") as one, open(piece_path, "rb") as two:
        files = one.read(), two.read()
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where("text <> ''")
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("weight")).select(text_key("text").alias("key"), "weight", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*files)
        for batch in batches:
            words = batch.column(2).to_pylist()
            for lo, hi in _runs(words):
                done = tool.align(words[lo:hi])
                numbers = [pa.array([getattr(d, n) for d in done], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
                digest = pa.array([hashlib.sha256(d.groups).hexdigest() if d.groups else "" for d in done], pa.string())
                columns = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *numbers, digest]
                columns += [_lists([d.pairs for d in done]), _lists([d.times for d in done])]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _OUT.split(", ")])

    return distinct.mapInArrow(run, _OUT)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): how often each id pair is linked in the corpus, and whether that is the most for its B id.

    Counted on the map side first. A B id has at most as many pairs as A has ids, so its window is bounded by the vocabulary.
    """
    links = aligned.select("weight", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = links.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum(F.col("link.times") * F.col("weight")).alias("count"))
    counts = counts.withColumn("id_b", F.col("pair").bitwiseAND(F.lit((1 << _SECOND) - 1)))
    most = counts.groupBy(F.col("id_b").alias("_id_b")).agg(F.max("count").alias("most"))
    return counts.join(most, F.col("id_b") == F.col("_id_b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Tokens have no empty bytes, so every byte offset where tokens of both sides end links one A with one B token and closes a group. A null or empty
    text, and one whose tokens' bytes differ from a blank and the text (the piece sign as a character, say), has zeros and ''. Repeated rows
    each get a row. Only the two columns are read, so others may have any name. An empty table gives an empty result.

    Stored: one row per different text with its different pairs, and the pair counts. How the pairs get their counts is Spark's choice: a broadcast
    while the stored counts are under ``spark.sql.autoBroadcastJoinThreshold``, else a shuffle by pair that AQE may split. Documents meet
    their text's measures by ``join_per_key``, which splits a text that many documents share.
    """
    aligned = materialize(align_distinct(docs, byte_level_path, piece_path, text_col))
    counts = materialize(pair_counts(aligned))
    links = aligned.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("key", F.col("link.pairs").alias("_pair"), F.col("link.times").alias("times"))
    found = links.join(counts, links["_pair"] == counts["pair"])
    sums = found.groupBy(F.col("key").alias("_key")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    measures = aligned.drop("pairs", "times", "weight").join(sums, F.col("key") == F.col("_key"), "left")
    measures = materialize(measures.select(F.col("key").alias("_text_key"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
    drop_stored(aligned)
    drop_stored(counts)
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), text_key(text_col).alias("_doc_key"))
    joined = join_per_key(rows, measures, [("_doc_key", "_text_key")], "left")
    zero = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return joined.select(id_col, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in zero], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
