"""Secret scan: fixed patterns, and strings in a sensitive context that zstandard, primed with what is known, cannot compress."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.sources.storage import materialize

# fixed values: the base patterns, and the least length of what they find
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16

KINDS = ("assign", "access", "hex", "novel")
CONTEXT = 256  # characters on either side of a candidate that prime the compressor
REACH = 64  # characters before a candidate, or before the first of candidate lines in a row, in which a sensitive word must stand
NOVELTY = 0.75  # a candidate's compressed size, at least, as a share of a random string's of its length and alphabet
DICTIONARY = 2048  # commonest identifiers around candidates, by distinct texts
_HINTS = ("password", "passwd", "secret", "token", "api")
_SENSITIVE = ("key", "secret", "token", "pass", "pwd", "auth", "bearer", "credential", "private", "signature")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_NEXT_LINE = re.compile(r"[\x20\t\r]*(?:\n|\\n)(?:[\x20\t\r\n]|\\[nr])*([A-Za-z0-9+/_=-]{16,})(?=[\x20\t\r]*(?:\n|\\|[\"']|\Z))")  # of a block; line ends may be escaped
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "+/_=-")
_HEXADECIMAL = ("0123456789abcdef", "0123456789ABCDEF")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,}")


class Span(NamedTuple):
    start: int
    kind: str
    end: int


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and not overlapping within a kind; code points, end exclusive."""
    out: list[Span] = []
    low = text.lower()
    if any(h in low for h in _HINTS):  # the pattern needs one of these
        out += [Span(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [Span(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [Span(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Strings of letters and digits, 16 or more, close after a sensitive word and outside of the base spans; also those that fill
    the lines after such a string, without a line of another kind between."""
    low = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
    done = 0
    for word in sorted({m for s in _SENSITIVE for m in _places(low, s)}):
        for m in _CANDIDATE.finditer(text, max(word, done), min(len(text), word + REACH + 512)):
            if m.start() > word + REACH:
                break
            start, end = m.start(), _CANDIDATE.match(text, m.start()).end()
            while start >= done:
                done = end
                found = text[start:end]
                mixed = any(c.isdigit() for c in found) and any(c.isalpha() for c in found)
                if mixed and not any(s.start < end and start < s.end for s in base):
                    yield start, end
                if following := _NEXT_LINE.match(text, end):
                    start, end = following.span(1)


def _places(text: str, word: str) -> Iterator[int]:
    at = text.find(word)
    while at >= 0:
        yield at + len(word)
        at = text.find(word, at + 1)


def random_bytes(candidate: str) -> float:
    """What a random string of the candidate's length and alphabet costs: hexadecimal digits of one case, or else the classes that it has characters of."""
    if any(set(candidate) <= set(a) for a in _HEXADECIMAL):
        return len(candidate) * 4 / 8
    return len(candidate) * math.log2(sum(len(a) for a in _ALPHABETS if set(candidate) & set(a))) / 8


def marginal_bytes(candidate: str, around: str, dictionary: bytes) -> int:
    """What a candidate adds to its compressed surroundings: its frame's size, primed with both dictionaries, less an empty frame's."""
    primed = zstandard.ZstdCompressionDict(dictionary + around.encode(errors="replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False)
    return len(made.compress(candidate.encode(errors="replace"))) - len(made.compress(b""))


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
_FOUND = pa.struct([("base", _SPANS), ("near", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("what", pa.string()), ("around", pa.string())])))])


def _blanked(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with blanks in the place of the spans, so that no secret makes another or itself known."""
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at:start] + " " * (end - max(start, at)))
        at = max(at, end)
    return "".join(out) + text[at:]


def _scan():
    @F.arrow_udf("struct<base:array<struct<start:int,kind:string,end:int>>,near:array<struct<start:int,end:int,what:string,around:string>>>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            text = value.as_py() or ""
            base = base_spans(text)
            spans = list(candidates(text, base))
            rest = _blanked(text, spans + [(s.start, s.end) for s in base]) if spans else ""
            near = [{"start": a, "end": b, "what": text[a:b], "around": rest[max(0, a - CONTEXT) : a] + " " + rest[b : b + CONTEXT]} for a, b in spans]
            out.append({"base": [s._asdict() for s in base], "near": near})
        return pa.array(out, _FOUND)

    return of


def _identifiers():
    @F.arrow_udf("array<string>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(_IDENTIFIER.findall(t.as_py() or ""))) for t in texts], pa.list_(pa.string()))

    return of


def _novel(dictionary: bytes, least: float):
    @F.arrow_udf("array<struct<start:int,kind:string,end:int>>")
    def of(rows: pa.Array) -> pa.Array:
        out = []
        for near in rows.to_pylist():
            fresh = [n for n in near or [] if marginal_bytes(n["what"], n["around"], dictionary) >= least * random_bytes(n["what"])]
            out.append([{"start": n["start"], "kind": "novel", "end": n["end"]} for n in fresh])
        return pa.array(out, _SPANS)

    return of


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", novelty: float = NOVELTY, dictionary: int = DICTIONARY) -> DataFrame:
    """(id, base, spans): for every row, the spans of the fixed patterns and all spans, as arrays of (start, kind, end) by start, then kind.

    Beyond the patterns, strings of 16 or more characters with letters and digits that follow a sensitive word within REACH characters are
    candidates, and so are the lines of a block (a key's body) that starts with one. A compressor primed with the ``dictionary`` commonest identifiers around all candidates of the corpus, counted over distinct texts, then
    with the candidate's own surroundings, both without candidates and base spans, tells how many bytes the candidate adds; from the share ``novelty`` of what a random string of its
    length and character classes costs on, it is reported (kind "novel"). A string that its surroundings or the common identifiers repeat is not.

    A null text is as an empty one and has no spans. Rows keep their number; ids may be null or repeated. Other columns are not read.
    """
    found = materialize(docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("text_key"), _scan()(F.col(text_col)).alias("f")).select("id", "text_key", "f.*"))
    near = found.select("text_key", F.explode("near").alias("n"))
    in_text = near.select("text_key", F.explode(_identifiers()("n.around")).alias("word")).distinct()  # copies of a text count once
    words = in_text.groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    common = [r.word for r in words.orderBy(F.desc("n"), "word").limit(dictionary).collect()]
    known = " ".join(reversed(common)).encode()  # the commonest last: nearest to what is compressed
    novel = F.when(F.size("near") > 0, _novel(known, novelty)("near")).otherwise(F.array().cast("array<struct<start:int,kind:string,end:int>>"))
    rank = F.array(*[F.lit(k) for k in KINDS])

    def before(a, b):
        x, y = F.array_position(rank, a["kind"]), F.array_position(rank, b["kind"])
        later = (a["start"] > b["start"]) | ((a["start"] == b["start"]) & (x > y))
        return F.when(later, 1).when((a["start"] == b["start"]) & (x == y), 0).otherwise(-1)

    return found.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", novel), before).alias("spans"))
