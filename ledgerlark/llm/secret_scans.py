"""Secrets in texts: patterns, and key or token encodings that are decoded and parsed before they count.

Three patterns give the base spans. Besides them, runs of base64 or hex digits and dotted triples are only
candidates: they are decoded, and count if the bytes are a private key in DER or OpenSSH form whose nested
lengths fit exactly, or a token with a readable header that names its signature algorithm. The lengths
inside a key also say where its span ends.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
#: A text without any of these, in lower case, cannot match ASSIGN.
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
#: A run that is too short cannot hold a later match, so the least length may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Candidates. Base64 may be wrapped into lines.
BASE64_RUN = re.compile(r"[A-Za-z0-9+/]{40,}(?:\r?\n[A-Za-z0-9+/]+)*={0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{64,}")
DOTTED = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{16,})(?![A-Za-z0-9_.-])")
SIGNATURE_BYTES = 16

#: Kinds in the order of spans that start at one place.
KINDS = ("assign", "access", "hex", "token", "der", "openssh")

OPENSSH = b"openssh-key-v1\0"
INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, first content byte, end) of the DER element at ``at``; None if it is not whole or not minimal."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        more = size & 0x7F
        if not 1 <= more <= 4 or at + more > end:
            return None
        size, at = int.from_bytes(data[at : at + more]), at + more
        if size < 0x80 or size >> (8 * (more - 1)) == 0:
            return None
    return (tag, at, at + size) if at + size <= end else None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill the bytes from ``at`` to ``end`` exactly; None if they do not."""
    found = []
    while at < end:
        item = der_item(data, at, end)
        if item is None:
            return None
        found.append(item)
        at = item[2]
    return found


def der_key(data: bytes) -> int | None:
    """The length of the private key (PKCS 1, PKCS 8, SEC 1 or DSA) that the bytes start with."""
    outer = der_item(data, 0, len(data))
    if outer is None or outer[0] != SEQUENCE:
        return None
    parts = der_items(data, outer[1], outer[2])
    if not parts or parts[0][0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        return None
    version, tags = data[parts[0][1]], [tag for tag, _, _ in parts]
    if version == 0 and tags in ([INTEGER] * 9, [INTEGER] * 6):
        return outer[2]
    if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS]:
        named = der_items(data, *parts[1][1:])
        inner = der_items(data, *parts[2][1:])
        return outer[2] if named and named[0][0] == OID and inner and len(inner) == 1 else None
    if version == 1 and tags[1:2] == [OCTETS] and parts[1][2] - parts[1][1] >= 16:
        return outer[2] if all(tag in (0xA0, 0xA1) for tag in tags[2:]) else None
    return None


def openssh_key(data: bytes) -> int | None:
    """The length of the OpenSSH private key that the bytes start with."""
    if not data.startswith(OPENSSH):
        return None
    at = len(OPENSSH)

    def string() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4])
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    cipher, derived, options = string(), string(), string()
    if None in (cipher, derived, options) or at + 4 > len(data):
        return None
    keys, at = int.from_bytes(data[at : at + 4]), at + 4
    if not 1 <= keys <= 64:
        return None
    for _ in range(keys):
        public = string()
        kind = public[4 : 4 + int.from_bytes(public[:4])] if public else b""
        if not kind.startswith((b"ssh-", b"ecdsa-", b"sk-")):
            return None
    private = string()
    if not private or cipher == b"none" and private[:4] != private[4:8]:
        return None
    return at


def unpadded(text: str) -> bytes | None:
    """Bytes of base64 digits of either alphabet without their padding; None if that cannot be."""
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text.replace("-", "+").replace("_", "/") + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def signed_token(match: re.Match) -> bool:
    """Whether the dotted parts are a header that names an algorithm, a payload and a signature."""
    try:
        header, payload = (json.loads(unpadded(match[i]) or b"") for i in (1, 2))
    except (ValueError, RecursionError):
        return False
    named = isinstance(header, dict) and isinstance(header.get("alg"), str) and header["alg"].lower() != "none"
    return named and isinstance(payload, dict) and len(unpadded(match[3]) or b"") >= SIGNATURE_BYTES


def decoded_keys(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of the private keys among the base64 and hex runs."""
    for match in BASE64_RUN.finditer(text):
        if match[0][0] not in "Mb":  # the first bytes of either form
            continue
        digits = re.sub(r"[\r\n=]", "", match[0])
        data = unpadded(digits[: len(digits) - (len(digits) % 4 == 1)]) or b""
        for kind, parse in (("der", der_key), ("openssh", openssh_key)):
            size = parse(data)
            if size:
                left, end = -(-size * 4 // 3), match.start()
                while left:
                    left -= text[end] not in "\r\n"
                    end += 1
                while end < match.end() and text[end] == "=":
                    end += 1
                yield match.start(), end, kind
    for match in HEX_RUN.finditer(text):
        data = bytes.fromhex(match[0][: len(match[0]) // 2 * 2])
        for kind, parse in (("der", der_key), ("openssh", openssh_key)):
            size = parse(data)
            if size:
                yield match.start(), match.start() + 2 * size, kind


def secret_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start, then kind; places are code points, the end exclusive."""
    low = text.lower()
    found = []
    if any(name in low for name in ASSIGN_NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    found += [(m.start(), m.end(), "token") for m in DOTTED.finditer(text) if signed_token(m)]
    found += decoded_keys(text)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row.

    Base spans are the three patterns' matches; ``spans`` has those of decoded keys and tokens too, which
    may overlap base spans. A null text counts as empty; a text without secrets has no spans, the hash of
    an empty list and counts of 0. Null and repeated ids keep a row each, an empty table gives none. A text
    is scanned as a whole in one task, whatever its length, in time proportional to it.
    """
    fields = [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS[:3]], ("base_sha256", pa.string()), ("spans", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = {k: [] for k in KINDS[:3]}, [], []
            for text in batch.column(1):
                found = secret_spans(text.as_py() or "")
                base = [x for x in found if x[2] in counts]
                for kind, own in counts.items():
                    own.append(sum(x[2] == kind for x in base))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(found))
            columns = [batch.column(0), *[pa.array(own, pa.int64()) for own in counts.values()], pa.array(digests), pa.array(spans)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
