"""SentencePiece coding: ids, spans and normal forms equal to the library's, odd input."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from salesops.llm.pieces import PieceCodec, encode_texts
from salesops.llm.queries import op11_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "a", "  two  blanks ", "tab\tand\r\nbreak\n", "<s>in text</s> <unk>", "▁already▁ there", "\x00zero\x00", "\U0001d518\U0001f600�́é",
       "　wide blank​nothing", "абв 中文", "x" * 3000, "long " * 5000]


def with_rules(rule):
    """The model with the compiled character map of a named rule, which drops repeated blanks as well."""
    spec = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    made = sentencepiece_model_pb2.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    spec.normalizer_spec.precompiled_charsmap = made.normalizer_spec.precompiled_charsmap
    spec.normalizer_spec.name = rule
    spec.normalizer_spec.remove_extra_whitespaces = True
    return spec.SerializeToString()


def noise(n, seed):
    rng = random.Random(seed)
    ranges = [(32, 126), (32, 33), (0xA0, 0x24F), (0x300, 0x36F), (0x3041, 0x30FF), (0xFF01, 0xFF9F), (0x1100, 0x11FF), (0x2460, 0x24FF), (0x2000, 0x200F), (9, 13), (0x1D400, 0x1D7FF), (0xFB00, 0xFB06)]
    return ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def agrees(model, texts):
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=model), PieceCodec(model)
    for text, got in zip(texts, codec.encode(texts, ends=False)):
        expected = library.encode(text, return_type="proto").pieces
        assert got.ids.tolist() == [p.id for p in expected], text
        assert list(zip(got.starts.tolist(), got.ends.tolist())) == [(p.begin, p.end) for p in expected], text


def test_ids_and_spans_equal_the_library(sf, spark):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r.text]
    agrees(MODEL, texts + ODD + noise(300, 1))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nfkc", "nmt_nfkc_cf"])
def test_compiled_rules_equal_the_library(rule):
    model = with_rules(rule)
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=model), PieceCodec(model)
    texts = ODD + noise(600, 2)
    for text in texts:
        assert codec.normalise(text)[0] == library.normalize(text), text
    assert len(codec.rules.rules) > 1000 and codec.rules.prefix("ｆ".encode(), 0) == (3, b"f")
    agrees(model, texts)


def test_unknown_pieces_without_bytes():
    spec = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    spec.trainer_spec.byte_fallback = False
    for piece in spec.pieces:
        if piece.type == 6:
            piece.type = 5  # unused
    agrees(spec.SerializeToString(), ["\U0001d518\U0001d519 known \U0001d51a", "plain"])


def test_user_defined_pieces():
    spec = sentencepiece_model_pb2.ModelProto.FromString(with_rules("nmt_nfkc"))
    for i, name in enumerate(["<tool>", "ＷＩＤＥ"]):
        spec.pieces[31000 + i].piece, spec.pieces[31000 + i].type = name, 4
    agrees(spec.SerializeToString(), ["a <tool>call ＷＩＤＥ ＷＩＤ <tool><tool>", "<tool"])


def plain(text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_query_equals_the_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op11_sentencepiece(spark, sf).collect()}
    assert got == {r.doc_id: plain(r.text) for r in docs}


def test_spans_cover_the_text_and_round_trip(spark):
    texts = [None, *ODD, *noise(50, 3)]
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(texts)], "doc_id bigint, text string, decoded string, ids array<int>")
    rows = encode_texts(df, PATH).collect()
    assert len(rows) == len(texts) and set(rows[0].asDict()) == {"doc_id", "text", "ids", "starts", "ends", "decoded"}
    for r in rows:
        data = (r.text or "").encode()
        assert list(r.starts[1:]) == list(r.ends[:-1]) and r.starts[0] == 0 and r.ends[-1] == len(data)
        assert b"".join(data[a:b] for a, b in zip(r.starts, r.ends)) == data
        assert r.ids == LIBRARY.encode(r.text or "", add_bos=True, add_eos=True) and r.decoded == LIBRARY.decode(r.ids)
    assert rows[0].ids == [1, 2]


def test_odd_tables(spark):
    schema = "doc_id bigint, text string, starts int, _piece_text string, near map<string,int>"
    df = spark.createDataFrame([(None, "same", 1, "q", {"a": 1}), (None, "same", 1, "q", {"a": 1})], schema)
    rows = encode_texts(df, PATH).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0]["near"] == {"a": 1} and rows[0]["_piece_text"] == "q"
    assert encode_texts(spark.createDataFrame([], schema), PATH).count() == 0
