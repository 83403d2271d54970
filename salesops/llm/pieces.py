"""SentencePiece encoding that keeps every piece's place in the original text, and decoding.

A text is normalised here, by the longest prefix that the model's compiled character map knows, and every normal byte remembers the
source character it comes from. The library then segments the normal text (with its own normaliser switched off), and each
piece's bytes are projected back to the source.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

# The sign that stands for a blank in pieces, what replaces nothing else, and the kinds of pieces.
BLANK = "▁".encode()
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6
CHUNK = 1 << 20  # bytes of text that are encoded at once


class CharMap:
    """The compiled character map of a model: a double array of byte transitions, then the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64)
        self.texts = blob[4 + size :]
        self.cells = self.units.tolist()
        self.rules: dict[bytes, bytes] = dict(self._rules())
        self.longest = max(map(len, self.rules), default=0)

    @staticmethod
    def _child_base(at: int, unit: int) -> int:
        return at ^ ((unit >> 10) << ((unit & (1 << 9)) >> 6))

    def _rules(self) -> Iterator[tuple[bytes, bytes]]:
        """All keys with their replacements, by a walk over the double array that tests a node's 255 labels at once."""
        labels = np.arange(1, 256)
        todo = [(self._child_base(0, self.cells[0]), b"")] if self.cells else []
        while todo:
            base, key = todo.pop()
            near = base ^ labels
            inside = near < len(self.units)
            hit = np.zeros(255, bool)
            hit[inside] = (self.units[near[inside]] & 0x800000FF) == labels[inside]
            for label in labels[hit].tolist():
                unit = self.cells[base ^ label]
                below, name = self._child_base(base ^ label, unit), key + bytes([label])
                if unit >> 8 & 1:
                    start = self.cells[below] & 0x7FFFFFFF
                    yield name, self.texts[start : self.texts.index(b"\0", start)]
                todo.append((below, name))

    def prefix(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """The longest key that stands at ``at``: its length and replacement."""
        for n in range(min(self.longest, len(data) - at), 0, -1):
            found = self.rules.get(data[at : at + n])
            if found is not None:
                return n, found
        return None

    def candidates(self) -> str:
        """A pattern for the places where a key may stand: a character with a rule of its own, or the first two of a longer key."""
        single, first, second = set(), set(), set()
        for key in self.rules:
            text = key.decode(errors="replace")
            single.add(text) if len(text) == 1 else (first.add(text[0]), second.add(text[1]))
        parts = [f"[{_class(single)}]"] * bool(single) + [f"[{_class(first)}](?=[{_class(second)}])"] * bool(first)
        return "|".join(parts)


def _class(chars: set[str]) -> str:
    return "".join(map(re.escape, sorted(chars)))


class Encoded(NamedTuple):
    """Ids of a text, and the byte range of the original text that each covers."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


class PieceCodec:
    """Encoder and decoder of one model file's bytes."""

    def __init__(self, model: bytes) -> None:
        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        self.decoder = SentencePieceProcessor(model_proto=model)
        self.rules = CharMap(spec.normalizer_spec.precompiled_charsmap) if spec.normalizer_spec.precompiled_charsmap else None
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        self.squeeze = spec.normalizer_spec.remove_extra_whitespaces
        self.escape = spec.normalizer_spec.escape_whitespaces
        self.suffix = spec.trainer_spec.treat_whitespace_as_suffix
        own = sorted((p.piece for p in spec.pieces if p.type == USER_DEFINED), key=len, reverse=True)
        parts = ["|".join(map(re.escape, own))] if own else []
        if self.rules and self.rules.rules:
            parts.append(self.rules.candidates())
        self.special = re.compile("|".join(parts)) if parts else None
        self.own = frozenset(own)
        self.width = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in spec.pieces], np.int64)
        self.unknown = {i for i, p in enumerate(spec.pieces) if p.type == UNKNOWN}
        # normal text is not normalised once more; samples that the model tests itself with are left out, as they would fail then
        plain = spec.normalizer_spec
        plain.name, plain.precompiled_charsmap = "identity", b""
        plain.add_dummy_prefix = plain.remove_extra_whitespaces = plain.escape_whitespaces = False
        spec.DiscardUnknownFields()
        self.segmenter = SentencePieceProcessor(model_proto=spec.SerializeToString())

    def _replaced(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Bytes after the rules of the character map, for each the byte at which its source begins, and where the first source
        that a rule removes begins (else the end)."""
        data = text.encode()
        source = np.frombuffer(data, np.uint8)
        heads = (source & 0xC0) != 0x80
        begin = np.maximum.accumulate(np.where(heads, np.arange(len(source)), 0)) if len(source) else np.zeros(0, np.int64)
        if self.special is None:
            return source, begin, len(data)
        at_char = np.flatnonzero(heads)
        out, origin, done, removed = [], [], 0, len(data)
        for found in self.special.finditer(text):
            at = int(at_char[found.start()])
            if at < done:
                continue
            own = found[0] in self.own
            rule = (len(found[0].encode()), found[0].encode()) if own else self.rules.prefix(data, at)
            if rule is None:
                continue
            n, new = rule
            removed = removed if new else min(removed, at)
            out += [source[done:at], np.frombuffer(new, np.uint8)]
            origin += [begin[done:at], np.full(len(new), at)]
            done = at + n
        out.append(source[done:])
        origin.append(begin[done:])
        return np.concatenate(out), np.concatenate(origin), removed

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normal text, and for each of its bytes and its end the byte of ``text`` from which it derives."""
        if not text:
            return "", np.zeros(1, np.int64)
        data, origin, removed = self._replaced(text)
        end = len(text.encode())
        if self.squeeze:
            space = data == 32
            keep = ~(space & np.concatenate([[True], space[:-1]])) if len(space) else space
            data, origin = data[keep], origin[keep]
            if len(data) and data[-1] == 32:
                end = int(origin[-1])
                data, origin = data[:-1], origin[:-1]
            if not len(data):
                return "", np.array([end])
        if self.prefix and not self.suffix:
            data, origin = np.concatenate([[np.uint8(32)], data]), np.concatenate([[min(origin[0], removed) if self.squeeze else 0], origin])
        elif self.prefix:
            data, origin = np.concatenate([data, [np.uint8(32)]]), np.concatenate([origin, [end]])
        origin = np.concatenate([origin, [end]])
        if self.escape:
            space = data == 32
            times = np.where(space, len(BLANK), 1)
            wide, last = np.repeat(data, times), np.cumsum(times)
            for i, byte in enumerate(BLANK):
                wide[(last - len(BLANK) + i)[space]] = byte
            data, origin = wide, np.repeat(origin, np.concatenate([times, [1]]))
        return data.tobytes().decode(errors="replace"), origin

    def encode(self, texts: list[str], ends: bool = True) -> list[Encoded]:
        """Ids and original byte ranges of texts; with ``ends``, the begin and end ids stand at the ends with empty ranges."""
        normal = [self.normalise(t) for t in texts]
        out = []
        for (text, origin), ids in zip(normal, self.segmenter.encode([t for t, _ in normal], num_threads=1)):
            ids = np.array(ids, np.int32)
            width = self.width[ids]
            if self.unknown and np.isin(ids, list(self.unknown)).any():  # such a piece has no bytes of its own
                width = np.array([1 if self.segmenter.is_byte(i) else len(p.encode()) for i, p in zip(ids.tolist(), self.segmenter.encode(text, out_type=str))])
            upto = np.concatenate([[0], np.cumsum(width)]).astype(np.int64)
            place = origin[upto].astype(np.int32)
            starts, stops = place[:-1], place[1:]
            if ends:
                ids = np.concatenate([[self.decoder.bos_id()], ids, [self.decoder.eos_id()]]).astype(np.int32)
                starts, stops = np.concatenate([place[:1], starts, place[-1:]]), np.concatenate([place[:1], stops, place[-1:]])
            out.append(Encoded(ids, starts, stops))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.decoder.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def codec(model: bytes) -> PieceCodec:
    """The codec of a model, made once in each worker."""
    return PieceCodec(model)


def _lists(parts: list[np.ndarray], packed: bool) -> pa.Array:
    if packed:
        return pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32)))


def _runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of about ``limit`` bytes."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


FIELDS = "ids array<int>, starts array<int>, ends array<int>, decoded string"


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text", ends: bool = True, packed: bool = False) -> DataFrame:
    """``docs`` with ``ids``, ``starts``, ``ends`` and ``decoded``, in place of columns so named.

    ``starts`` and ``ends`` are byte ranges of the UTF-8 text: together they cover it from left to right without gaps, save that
    characters which the model drops at the end of a text belong to no piece. Of a character that becomes several byte pieces the
    last one carries it and the others are empty. ``decoded`` is what the ids decode to. With ``packed`` the three lists are binaries of
    little-endian unsigned 32-bit integers, as token files hold them, instead of arrays.

    The model file is read once, by the driver, and sent along (some hundred KB, whatever the data). No shuffle; a task encodes
    texts in runs of about 1 MB. A null text is as an empty one: with ``ends`` the begin and end ids only. Repeated rows and
    all other columns stay; an empty table gives an empty result.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    own = [f.split()[0] for f in FIELDS.split(", ")]
    kept = [c for c in docs.columns if c.lower() not in own or c == text_col]
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("_text" + "_".join(["", *docs.columns])), *[F.col(f"`{c}`") for c in kept])
    outside = [i for i, f in enumerate(rows.schema.fields) if i and f.name.lower() not in own]
    schema = T.StructType([*[rows.schema.fields[i] for i in outside], *T.StructType.fromDDL(FIELDS.replace("array<int>", "binary") if packed else FIELDS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            others = [batch.column(i) for i in outside]
            for lo, hi in _runs([len(t) for t in texts], CHUNK):
                done = tool.encode(texts[lo:hi], ends)
                columns = [c.slice(lo, hi - lo) for c in others]
                columns += [_lists([getattr(e, name) for e in done], packed) for name in ("ids", "starts", "ends")]
                columns.append(pa.array(tool.decode([e.ids.tolist() for e in done]), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)
