"""Document fingerprints: a homomorphic multiset hash, the sum of wide vectors hashed from a text's paragraphs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.llm.shingles import run_hashes, word_hashes, words_of

EQUAL_LANES = 16  # 64-bit lanes modulo 2^64: equality of multisets of paragraphs
LIKE_LANES = 64  # 32-bit lanes modulo 2^32: likeness
SHINGLE = 5
_SEEDS = np.random.default_rng(99).integers(0, 2**63, EQUAL_LANES, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _paragraph(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of one paragraph: pseudo-random 64-bit lanes of its bytes, and per bit the signs of its word shingles, summed."""
    digest = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), np.uint64)
    x = (digest[0] ^ _SEEDS) * _ODD
    x ^= (x >> np.uint64(31)) ^ digest[1]
    x *= _ODD
    equal = x ^ (x >> np.uint64(29))
    words = word_hashes(words_of(text))
    shingles = run_hashes(words, min(SHINGLE, len(words))) if len(words) else words
    like = np.zeros(LIKE_LANES, np.int64)
    for i in range(0, len(shingles), 1 << 16):
        bits = np.unpackbits(shingles[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        like += 2 * bits.sum(axis=0, dtype=np.int64) - len(bits)
    return equal, like.astype(np.uint32)


class Fingerprint:
    """A sum of paragraph vectors. Paragraphs may be put in and taken out in any order; equal multisets give equal sums."""

    def __init__(self) -> None:
        self.equal, self.like = np.zeros(EQUAL_LANES, np.uint64), np.zeros(LIKE_LANES, np.uint32)

    @classmethod
    def of(cls, text: bytes | None) -> Fingerprint:
        """Of a text cut at line feeds; blank paragraphs count too. Null is as empty."""
        made = cls()
        for paragraph in (text or b"").split(b"\n"):
            made.insert(paragraph)
        return made

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        made, data = cls(), bytes.fromhex(text)
        made.equal = np.frombuffer(data[: 8 * EQUAL_LANES], ">u8").astype(np.uint64)
        made.like = np.frombuffer(data[8 * EQUAL_LANES :], ">u4").astype(np.uint32)
        return made

    def insert(self, paragraph: bytes) -> None:
        equal, like = _paragraph(paragraph)
        self.equal, self.like = self.equal + equal, self.like + like

    def delete(self, paragraph: bytes) -> None:
        equal, like = _paragraph(paragraph)
        self.equal, self.like = self.equal - equal, self.like - like

    def __str__(self) -> str:
        return self.equal.astype(">u8").tobytes().hex() + self.like.astype(">u4").tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the cosine of the two sums of signs, none below 0: it estimates that of the shingle counts."""
        if np.array_equal(self.equal, other.equal):
            return 1.0
        a, b = self.like.view(np.int32).astype(float), other.like.view(np.int32).astype(float)
        size = np.sqrt((a @ a) * (b @ b))
        return float(min(max(a @ b / size, 0.0), 1.0)) if size else 0.0


def half_replaced(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, lent, id, text) in order; each with the row after it, the bucket's last with the one lent to it."""
    held: tuple | None = None
    for batch in batches:
        out: list[tuple] = []
        for bucket, lent, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            mine = Fingerprint.of(text.encode())
            if held is not None and held[0] == bucket:
                _, old_key, old_text, old = held
                edited = half_replaced(old_text, text)
                data = edited.encode()
                changed = Fingerprint.of(data)
                out.append((old_key, len(old_text), hashlib.sha256(data).hexdigest(), str(old), str(changed), old.likeness(changed), old.likeness(mine)))
            held = None if lent else (bucket, key, text, mine)
        names = [f.split()[0] for f in _OUT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint of every text and of its edited text (``half_replaced`` by the next document's), and how alike they are.

    The next document is the one before in id order: rows are walked by descending id (nulls last, then by descending hash of the text), after the last comes
    the first. Rows are dealt into ranges of ids whose bounds are quantiles (one per shuffle partition), sorted inside them and streamed, so
    a task holds two texts at a time; each range lends its first row to the range before it. Only the bounds and those rows' ids are
    gathered, one per range. Rows of one id all lie in one range, whatever their number.

    Null texts are as empty ones, with n_chars 0. A table of one row is its own next document. Repeated rows follow each other. Other columns are not read. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    cuts = sorted(set(rows.select("id").approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    # range 0 holds the largest ids; null ids come with the smallest
    bounds = F.array(*[F.lit(int(c)).cast("bigint") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    above = F.size(F.filter(bounds, lambda c: F.coalesce(F.col("id") < c, F.lit(True))))
    ranged = rows.withColumn("bucket", above).withColumn("h", F.xxhash64("text"))
    top = F.max(F.struct(F.col("id").isNotNull().alias("some"), "id", "h")).alias("top")
    heads = sorted((r.bucket, r.top.id, r.top.h) for r in ranged.groupBy("bucket").agg(top).collect())
    lent = [(bucket, key, h, heads[i - 1][0]) for i, (bucket, key, h) in enumerate(heads)]
    lent = F.broadcast(spark.createDataFrame(lent, "_bucket int, _id bigint, _h bigint, home int"))
    match = (F.col("bucket") == F.col("_bucket")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    own = F.struct("bucket", F.lit(False).alias("lent"))
    homes = F.when(F.col("home").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("home").alias("bucket"), F.lit(True).alias("lent"))))
    dealt = ranged.join(lent, match, "left").select("id", "text", "h", F.inline(homes))
    walked = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "lent", F.col("id").desc_nulls_last(), F.col("h").desc())
    return walked.select("bucket", "lent", "id", "text").mapInArrow(_walk, _OUT).withColumnRenamed("doc_id", id_col)
