"""The named queries of this subpackage over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.llm import align, embed_dedup, fingerprint, line_dedup, merkle, minhash, mixing, packing, pieces, quality, secrets, suffix_dedup, toxicity
from salesops.sources.tables import load


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the fixed patterns, and all spans."""
    found = secrets.find_secrets(load(spark, sf_dir, "documents"))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in optimal length buckets and token-budget batches."""
    return packing.pack(load(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, site prior and verdict for every document."""
    scored = quality.score_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return scored.select("doc_id", "source", "lang", "evidence", "site_prior", "quality", "accepted")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every vector: equal label and cosine 0.93."""
    return embed_dedup.near_vectors(load(spark, sf_dir, "embeddings"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of a document made of passages of over 50 words that stand elsewhere too."""
    return suffix_dedup.repeated_passages(load(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and offending sentences of every document; learnt without the held-out fifth."""
    labels = load(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, labels)
    spans = F.array_join(F.transform("toxicity.spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    score = F.col("toxicity.score")
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), spans.alias("sentences"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprint.edited_fingerprints(load(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with each fuzzy line kept once in the corpus."""
    return line_dedup.dedup_lines(load(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: four-word shingles, similarity 0.8."""
    return minhash.near_duplicates(load(spark, sf_dir, "documents"), words=4, percent=80)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document in the mixture, with its place in its source's epochs."""
    return mixing.mix(load(spark, sf_dir, "documents")).select("doc_id", "source", "epoch", "block_rank", "order_key")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, their spans in the original bytes, and the decoded text of every document, as digests."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), packed=True)
    digests = [F.sha2(c, 256).alias(n) for c, n in (("ids", "ids_sha256"), ("decoded", "decoded_sha256"), (F.concat("starts", "ends"), "spans_sha256"))]
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), *digests)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two public tokenizers meet in every document."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align.align_documents(load(spark, sf_dir, "documents"), *paths)


def manifest_rows(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, checked with the text of a fifth of them in lower case (A-Z only)."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    text = F.when(tampered, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))
    changed = F.when(tampered, merkle.leaf_digest([text if f == "text" else F.col(f) for f in merkle.FIELDS]))
    tree = merkle.build(docs, carry={"changed": changed})
    folded = merkle.fold(F.coalesce("carried.changed", "leaf"), F.col("steps"))
    root = F.lit(tree.root).cast("string")
    rows = tree.rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), merkle.proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its possibly changed text still gives the root."""
    return manifest_rows(load(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over documents."""
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_packing, op3_quality_classifier, op4_embedding_near_dedup, op5_repeated_passages, op6_toxicity,
        op7_fingerprints, op8_line_dedup, op9_minhash_near_dedup, op10_mixing, op11_sentencepiece,
        op12_token_alignment, op13_merkle_manifest, pipeline,
    )
}
LLM_ORACLE: dict[str, str] = {}
