"""Byte-level BPE encoding and decoding with a sentencepiece model built from a rank file.

The rank file (base64 of a token's bytes, its rank, one a line) becomes a sentencepiece BPE
model: every byte is the character of its number (byte 0, which a piece can't hold, is U+0100), a token is the string of its bytes, its
score is minus its rank, and normalisation is the identity.  The best-scored merge is then the
merge of lowest rank, as byte-level BPE asks.  Texts are cut by the pre-token
pattern, each pre-token that is a token gets its rank, every other one is encoded by the
model; decoding maps ids back to bytes.

The model (about 1 MB, a fixed vocabulary) is serialised on the driver and broadcast, so workers
need no file.  Each worker keeps the ids of up to CACHE distinct pre-tokens.

Defined results: a null text counts as empty and has no ids; special tokens are ordinary text;
repeated rows are encoded row by row; very long texts and pre-tokens are encoded whole; an empty table gives an empty result; extra columns
are ignored.  Unpaired surrogates can't occur in Spark strings.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import arrow_map

CACHE = 1 << 18
_LONGEST = 64  # longer pre-tokens are not kept


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank; ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if not all(tokens):
        raise ValueError("the ranks are not 0, 1, 2, ... without a gap")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: varint, 32-bit float or length-delimited."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def mapped(data: bytes) -> str:
    """Bytes as the characters that stand for them."""
    return data.decode("latin-1").replace("\0", "\u0100")


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model proto: a piece for each token, id = rank, and the unknown piece after them."""
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, _field(1, mapped(t).encode()) + _field(2, -float(rank)) + _field(3, normal))
              for rank, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    no_id = (1 << 64) - 1  # -1
    trainer = (_field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(41, no_id)
               + _field(42, no_id) + _field(43, no_id))
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no prefix, no trimming, no escapes
    return b"".join(pieces) + _field(2, trainer) + _field(3, identity)


def latin_pattern(pattern: str) -> str | None:
    """The pattern for texts of the first 256 characters alone, its classes spelt out for the faster standard engine.

    None if it has a class that isn't known here.
    """
    import regex
    members = {c: "".join(re.escape(chr(k)) for k in range(256) if regex.match(c, chr(k))) for c in (r"\p{L}", r"\p{N}", r"\s")}

    def spell(part: str, wrap: str) -> str:
        for c, chars in members.items():
            part = part.replace(c, wrap.format(chars))
        return part.replace(r"\S", f"[^{members[r'\s']}]")
    pieces = re.split(r"(\[[^\]]*\])", pattern)  # odd ones are bracketed
    twin = "".join(spell(x, "{}" if k % 2 else "[{}]") for k, x in enumerate(pieces))
    return None if r"\p" in twin or re.search(r"\\[A-Za-z]", twin.replace("\\\\", "")) else twin


class Codec:
    """Encoder and decoder of one process."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.known: dict[str, bytes] = {}  # packed ids by pre-token
        self.split = regex.compile(pattern).findall
        twin = latin_pattern(pattern)
        self.split_latin = re.compile(twin).findall if twin else self.split

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """Packed ids of pre-tokens: a token's own rank, else what the model finds, all in one call."""
        data = [p.encode() for p in parts]
        rest = [i for i, d in enumerate(data) if d not in self.rank]
        out = {p: struct.pack("<I", self.rank[d]) for p, d in zip(parts, data) if d in self.rank}
        coded = self.pieces.encode([mapped(data[i]) for i in rest], out_type=int, num_threads=1) if rest else []
        packed = np.fromiter(chain.from_iterable(coded), dtype="<u4").tobytes()
        at = 0
        for i, ids in zip(rest, coded):
            out[parts[i]] = packed[at:at + 4 * len(ids)]
            at += 4 * len(ids)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [(self.split_latin if _is_latin(t) else self.split)(t) if t else [] for t in texts]
        found = [list(map(self.known.get, parts)) for parts in cut]
        gaps = [[i for i, x in enumerate(ids) if x is None] for ids in found]
        fresh = self._learn(list({parts[i] for parts, gap in zip(cut, gaps) for i in gap}))
        for parts, ids, gap in zip(cut, found, gaps):
            for i in gap:
                ids[i] = fresh[parts[i]]
        if len(self.known) > CACHE:  # keep what this batch uses
            self.known = {p: self.known[p] for p in set().union(*cut) if p in self.known}
        self.known.update((p, x) for p, x in fresh.items() if len(p) <= _LONGEST)
        return [b"".join(ids) for ids in found]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")]) if ids else b""


def _is_latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


_codecs: dict[tuple, Codec] = {}


def _codec(held, pattern: str) -> Codec:
    """The codec of this worker process for a broadcast model."""
    model, tokens = held.value
    key = (zlib.crc32(model), len(model), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model, tokens, pattern)
    return _codecs[key]


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, packed) and decoded (bytes) of every row."""
    tokens = read_ranks(path)
    held = documents.sparkSession.sparkContext.broadcast((serialise(tokens), tokens))
    rows = documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(held, pattern)
        ids = codec.encode(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.binary())],
            ["doc_id", "ids", "decoded"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {kind}, ids binary, decoded binary")
