"""Cross-tokenizer alignment against a plain version; copies, odd texts, odd tables."""

import hashlib
import json
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from salesops.llm.align import align_documents, align_distinct, pair_counts
from salesops.llm.queries import op12_token_alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def sign_bytes():
    shown = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table, extra = {}, 0
    for b in range(256):
        if b in shown:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def tokens_of(text, a, b, table):
    """Lists of (id, end) of both sides, or None."""
    out = []
    for pieces in (
        [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)],
    ):
        if b"".join(x for _, x in pieces) != (" " + text).encode():
            return None
        end, side = 0, []
        for i, x in pieces:
            end += len(x)
            side.append((i, end))
        out.append(side)
    return out


def plain(texts):
    """The measures of each text of a list, by dictionaries of ends."""
    a, b, table = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH), sign_bytes()
    a.encode_special_tokens = True
    sides = [tokens_of(t, a, b, table) if t else None for t in texts]
    counts = Counter()
    links = []
    for side in sides:
        ends = {f: y for y, f in side[1]} if side else {}
        own = [(x, ends[e]) for x, e in side[0] if e in ends] if side else []
        links.append(own)
        counts.update(own)
    best = Counter()
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for side, own in zip(sides, links):
        if not side:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = {e for _, e in side[0]} & {e for _, e in side[1]}
        halves = []
        for part in side:
            bag, run = [], []
            for i, e in part:
                run.append(str(i))
                if e in cuts:
                    bag.append(",".join(run))
                    run = []
            halves.append(bag)
        groups = [f"{x}|{y}" for x, y in zip(*halves)]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((len(side[0]), len(side[1]), len(cuts), len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), digest))
    return out


def values(rows):
    return [tuple(r[c] for c in COLUMNS) for r in rows]


ODD = [None, "", " ", "a", "a", "a", "<|endoftext|> and <s>", "▁piece sign", "\x00\x01\t\r\n", "日本語 и кириллица é é", "\U0001d518\U0001f600",
       "  two  blanks\n\n", "word " * 4000, "x" * 2000, "tokenization's unbelievably", "﻿mark", "�"]


def test_query_equals_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = values(op12_token_alignment(spark, sf).orderBy("doc_id").collect())
    assert got == plain([r.text for r in docs])


def test_odd_texts_and_copies(spark):
    texts = [*ODD, *["tokenization's unbelievably"] * 30]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id bigint, text string, key string, pairs int")
    rows = align_documents(df, A_PATH, B_PATH).orderBy("doc_id").collect()
    assert values(rows) == plain(texts) and rows[0].asDict().keys() == {"doc_id", *COLUMNS}
    assert values(rows)[7] == (0, 0, 0, 0, 0, 0, "") == values(rows)[0] == values(rows)[1]


def test_each_text_is_aligned_once(spark):
    df = spark.createDataFrame([("same text",)] * 40 + [("other text",)], "text string")
    rows = align_distinct(df, A_PATH, B_PATH)
    assert sorted((r.weight, len(r.pairs)) for r in rows.select("weight", "pairs").collect()) == [(1, 2), (40, 2)]
    counts = {r["pair"]: r["count"] for r in pair_counts(rows).collect()}
    assert sorted(counts.values()) == [1, 40, 41]


def test_ties_are_both_best(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "one two"), (None, "three"), (None, "three")], "doc_id bigint, text string")
    rows = align_documents(df, A_PATH, B_PATH).collect()
    assert len(rows) == 4 and all(r.n_best == r.n_links == r.n_groups > 0 for r in rows)


def test_empty_table(spark):
    assert align_documents(spark.createDataFrame([], "doc_id bigint, text string"), A_PATH, B_PATH).count() == 0


def test_counts_do_not_need_a_broadcast(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(align_documents(df, A_PATH, B_PATH).orderBy(F.col("doc_id")).collect()) == plain(ODD)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_vocabulary_bytes_are_the_rank_file():
    import base64

    from salesops.llm.align import Aligner

    tool = Aligner(open(A_PATH, "rb").read(), open(B_PATH, "rb").read())
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {int(i): base64.b64decode(x) for x, i in map(bytes.split, file)}
    assert all(tool.bytes_a[i] == x for i, x in ranks.items()) and len(json.loads(open(A_PATH).read())["model"]["vocab"]) >= len(ranks)
