"""Byte-level BPE through a sentencepiece model serialised from a rank file, and its inverse.

Bytes are mapped to 256 printable characters; a piece is a mapped token, its score the negative rank, so
merging the best-scored pair is merging the lowest-ranked one. Normalisation is the identity. Each match
of the split pattern is encoded by itself.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import blocks

CACHE_ENTRIES = 250_000
CACHE_CHARS = 64
DECODED_AT_ONCE = 1 << 20


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes by length, ints as varints, floats as 32 bits."""
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in order of rank; ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece numbers are the ranks; one unknown piece comes after them."""
    chars = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    pieces = b"".join(
        field(1, field(1, "".join(chars[b] for b in token).encode()) + field(2, float(-rank)) + field(3, normal))
        for rank, token in enumerate(tokens)
    )
    pieces += field(1, field(1, b"<unk>") + field(2, 0.0) + field(3, unknown))
    trainer = field(3, bpe) + field(4, len(tokens) + 1) + field(40, len(tokens))
    trainer += field(41, -1) + field(42, -1) + field(43, -1)
    normalizer = field(1, b"identity") + field(3, 0) + field(4, 0) + field(5, 0)
    return pieces + field(2, trainer) + field(3, normalizer)


class Chunks(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of text chunks; a bounded cache."""

    def __init__(self, encode, prefix: str = "") -> None:
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(self.prefix + chunk)
        if len(self) < CACHE_ENTRIES and len(chunk) <= CACHE_CHARS:
            self[chunk] = ids
        return ids


class ByteBpe:
    def __init__(self, path: str, pattern: str) -> None:
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.pattern = regex.compile(pattern)
        self.mapping = byte_characters()
        self.matches = Chunks(self.encode_match)
        self.first, self.later = Chunks(self.encode_plain), Chunks(self.encode_plain, " ")
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.ambiguous = re.compile(r"\s (?:\s|\Z)")

    def encode_plain(self, text: str) -> bytes:
        """Every match of the pattern is mapped and encoded by the model."""
        return b"".join(map(self.matches.__getitem__, self.pattern.findall(text)))

    def encode_match(self, match: str) -> bytes:
        ids = self.model.encode(match.encode().decode("latin-1").translate(self.mapping))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """A match never reaches over a space that stands next to a character of a word, so texts are cut there."""
        if self.ambiguous.search(text):
            return self.encode_plain(text)
        words = text.split(" ")
        return b"".join([self.first[words[0]], *map(self.later.__getitem__, words[1:])])

    def decode(self, ids: bytes) -> bytes:
        """Bytes of all tokens, gathered from one table of the tokens' bytes."""
        numbers = np.frombuffer(ids, "<u4")
        out = []
        for at in range(0, len(numbers), DECODED_AT_ONCE):
            part = numbers[at : at + DECODED_AT_ONCE]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            places = np.repeat(self.places[part] - ends + lengths, lengths)
            places += np.arange(len(places))
            out.append(self.table[places].tobytes())
        return b"".join(out)


@lru_cache(maxsize=1)
def loaded(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def per_text(work, path: str, pattern: str, schema: pa.Schema):
    """For mapInArrow over (id, value): the id with what ``work`` returns for each value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path, pattern)
        for batch in batches:
            for row, data, offsets in blocks(batch.column(1)):
                raw, ends = data.tobytes(), offsets.tolist()
                rows = [work(coder, raw[a:b]) for a, b in zip(ends, ends[1:])]
                ids = batch.column(0).slice(row, len(rows))
                values = [pa.array(x, f.type) for x, f in zip(zip(*rows), list(schema)[1:])]
                yield pa.RecordBatch.from_arrays([ids.cast(schema.field(0).type), *values], schema=schema)

    return run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): whole texts as little-endian unsigned 32-bit ids; null and empty have none.

    A row for each row, repeated and null ids included; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def work(coder: ByteBpe, raw: bytes):
        ids = coder.encode(raw.decode())
        return len(ids) // 4, ids

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(per_text(work, path, pattern, schema), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded): the bytes that the ``ids`` of each row stand for."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(
        per_text(lambda coder, ids: (coder.decode(ids),), path, pattern, schema), "doc_id long, decoded binary"
    )


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass, digests only."""
    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]

    def work(coder: ByteBpe, raw: bytes):
        ids = coder.encode(raw.decode())
        decoded = coder.decode(ids)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        per_text(work, path, pattern, pa.schema(kinds)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
