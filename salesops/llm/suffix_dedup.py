"""Repeated passages by sparse suffix arrays: suffixes that start at content-selected positions, equal neighbours, matches extended both ways."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.llm.shingles import run_hashes, word_hashes
from salesops.operators.skew import join_per_key
from salesops.sources.storage import drop_stored, materialize, release

MIN_WORDS = 51  # of a passage: over 50
PREFIX = 20  # words by which suffixes are ordered and compared first


def _slide(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``size`` neighbouring values, by doubling."""
    out, width = values, 1
    while width < size:
        step = min(width, size - width)
        out = pick(out[: len(out) - step], out[step:])
        width += step
    return out


def sampled_suffixes(prefixes: np.ndarray, window: int) -> np.ndarray:
    """Positions whose prefix hash is the least in some ``window`` neighbouring positions, ties included.

    The choice depends on those words alone, so a passage with ``window`` positions has a suffix sampled wherever it stands, and the same one.
    """
    if len(prefixes) < window:
        return np.zeros(0, np.int64)
    least = _slide(prefixes, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    highest = _slide(np.concatenate([edge, least, edge]), window, np.maximum)
    return np.nonzero(prefixes == highest)[0]


def _words(text: bytes) -> tuple[list[bytes], np.ndarray]:
    words = text.lower().split()
    return words, word_hashes(words)


_SAMPLED = "key bigint, text_key bigint, pos int, start int, end int"


def _sample(min_words: int, prefix: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, text_key, pos) of the sampled suffixes of (text_key, text), and for each text a row without key: its words, start and end."""
        for batch in batches:
            keys, texts, places, start, end = [], [], [], [], []
            for text_key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                words, hashes = _words(text)
                if len(words) < min_words:
                    continue
                runs = run_hashes(hashes, prefix)
                at = sampled_suffixes(runs, min_words - prefix + 1)
                keys += [pa.array(runs[at].view(np.int64)), pa.nulls(1, pa.int64())]
                texts.append(pa.array(np.full(len(at) + 1, text_key.as_py(), np.int64)))
                places.append(pa.array(np.append(at, len(words)).astype(np.int32)))
                blank = len(text) - len(text.lstrip())
                start += [pa.nulls(len(at), pa.int32()), pa.array([blank], pa.int32())]
                end += [pa.nulls(len(at), pa.int32()), pa.array([blank + len(text.strip().decode(errors="replace"))], pa.int32())]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in (keys, texts, places, start, end)], ["key", "text_key", "pos", "start", "end"])

    return of


def _starts(text: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends, in code points of the text."""
    data = np.frombuffer(text, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    point = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    return point[np.nonzero(edge == -1)[0]] - 1, point[np.nonzero(edge == 1)[0] - 1]


def _extend(min_words: int, prefix: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h, id, pos, start, chars): for rows (id, text, places), every run of ``min_words`` words that holds the prefix of a matched suffix."""
        for batch in batches:
            for key, text, places in zip(*batch.columns):
                text = text.as_py()
                words, hashes = _words(text)
                near = np.zeros(len(words) + 1, np.int64)
                last = len(words) - min_words
                for p in places.as_py():
                    near[max(0, p + prefix - min_words)] += 1
                    near[min(p, last) + 1] -= 1
                at = np.nonzero(np.cumsum(near)[: last + 1] > 0)[0]
                start, end = _starts(text, words)
                columns = [
                    pa.array(run_hashes(hashes, min_words)[at].view(np.int64)), pa.array(np.full(len(at), key.as_py(), np.int64)), pa.array(at.astype(np.int32)),
                    pa.array(start[at].astype(np.int32)), pa.array((end[at + min_words - 1] - start[at]).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["h", "id", "pos", "start", "chars"])

    return of


def _merge(min_words: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, start, end, first_word, n_words): the runs of each text that touch or overlap, joined."""
        for batch in batches:
            out = []
            for key, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                first = start = stop = end = None
                for x in at:
                    if stop is None or x["pos"] > stop:
                        if stop is not None:
                            out.append((key, start, end, first, stop - first))
                        first, start = x["pos"], x["start"]
                    stop, end = x["pos"] + min_words, x["start"] + x["chars"]
                out.append((key, start, end, first, stop - first))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)], ["id", "start", "end", "first_word", "n_words"])

    return of


def _with_equals(rows: DataFrame, key: str, several: DataFrame, name: str) -> DataFrame:
    """The rows whose hash is in ``several``, an aggregate of it.

    The lowest bit as a further join key makes Spark shuffle both sides for the join, so that AQE can split a hot hash (see ``join_per_key``,
    whose further hash would be as large as the rows here).
    """
    some = several.withColumn("_low", F.pmod(name, F.lit(2)))
    return rows.join(some, (F.col(key) == F.col(name)) & (F.pmod(key, F.lit(2)) == F.col("_low")))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, prefix: int = PREFIX) -> DataFrame:
    """(id, start, end, first_word, n_words): the maximal stretches of every text made of passages of ``min_words`` words or more that stand
    elsewhere too, in another text or the same one; ``start`` and ``end`` in code points. Texts without such a passage have no row.

    Words are cut at ASCII blanks, A-Z lower-cased. Texts are sparse suffix arrays: of the suffixes, those at minimisers of ``prefix`` words are
    kept, dense enough that every passage holds one. Brought into the order of their prefixes, equal suffixes are neighbours, and only those with
    an equal neighbour go on. Each is then extended, word by word to the left and correspondingly to the right, and the extended suffixes
    are compared with their neighbours again over ``min_words`` words. Neighbours are told by the least and greatest place of an equal group, which
    are partial aggregates: a passage that a third of all texts share is no burden, and no pairs are formed.

    Equal texts are taken as one; if there are several, all of the text is repeated. Null, empty and shorter texts have no passage. Rows
    without an id take no part, rows of equal id are joined by their text. Other columns are not read.
    """
    if not 0 < prefix <= min_words:
        raise ValueError("prefix must be within min_words")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")).where("id is not null and text is not null")
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    sampled = materialize(rows.select("text_key", "text").mapInArrow(_sample(min_words, prefix), _SAMPLED))
    anchors = sampled.where("key is not null").select("key", "text_key", "pos")
    place = F.xxhash64("text_key", "pos")
    several = anchors.groupBy(F.col("key").alias("_key")).agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo < hi").select("_key")
    hits = _with_equals(anchors, "key", several, "_key").groupBy(F.col("text_key").alias("_text")).agg(F.collect_set("pos").alias("places"))
    owners = materialize(rows.groupBy("text_key").agg(F.min("id").alias("owner"), F.count("*").alias("copies")))
    hits = hits.join(owners.select("text_key", "owner"), F.col("_text") == F.col("text_key")).select("_text", "owner", "places")
    hits = materialize(hits)
    sizes = sampled.where("key is null").groupBy(F.col("text_key").alias("_text")).agg(F.min("start").alias("start"), F.min("end").alias("end"), F.min("pos").alias("n_words"))
    copies = owners.where("copies > 1").select(F.col("text_key").alias("_text"), "owner")
    sizes = materialize(copies.join(sizes, "_text"))
    drop_stored(sampled)
    release(docs.sparkSession)
    held = rows.join(hits, (F.col("text_key") == F.col("_text")) & (F.col("id") == F.col("owner"))).select("id", "text", "places")
    runs = materialize(held.mapInArrow(_extend(min_words, prefix), "h bigint, id bigint, pos int, start int, chars int"))
    release(docs.sparkSession)
    place = F.xxhash64("id", "pos")
    again = runs.groupBy(F.col("h").alias("_h")).agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo < hi").select("_h")
    found = _with_equals(runs, "h", again, "_h").groupBy("id").agg(F.array_sort(F.collect_set(F.struct("pos", "start", "chars"))).alias("at"))
    spans = materialize(found.mapInArrow(_merge(min_words), "id bigint, start int, end int, first_word int, n_words int"))
    drop_stored(runs)

    whole = join_per_key(rows.select("id", "text_key"), sizes, [("text_key", "_text")], "inner").select("id", "start", "end", F.lit(0).alias("first_word"), "n_words")
    single = spans.join(copies.select("owner"), F.col("id") == F.col("owner"), "left_anti")
    return single.union(whole).withColumnRenamed("id", id_col)
