"""Bytes, words and hashes of Arrow text batches, shared by the operators of this folder.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D. Texts are handled as UTF-8 in blocks
of bounded size, so memory does not follow the batch; only one very long text makes a longer block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.session import show_package

BLOCK_BYTES = 2 << 20
#: Rows of an Arrow batch in place of Spark's 10,000, which can be hundreds of MB of texts.
BATCH_ROWS = 1_000
ROOT = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * ROOT)
#: The same with A-Z valued as a-z.
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ROOT and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(ROOT), -1, 1 << 64))
    up, down = np.full(n, ROOT), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in the bytes) of consecutive rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(ends, ends[row] + limit, "right")) - 1
        last = min(max(last, row + 1), len(texts))
        yield row, data[ends[row] : ends[last]], ends[row : last + 1] - ends[row]
        row = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the number of words before it (one more entry)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~SPACE[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    start[cuts] = word[cuts]
    end[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES
) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):  # in pieces: a very long text must not need long tables
        base = starts[first]
        last = max(int(np.searchsorted(ends, base + BLOCK_BYTES, "right")), first + 1)
        piece = data[base : ends[last - 1]]
        size = max(1 << 16, 1 << int(len(piece)).bit_length())
        up, down = powers(size)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * up[: len(piece)], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * ROOT
        first = last
    return mix(out)


def sequence_hashes(items: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive items; the length shrinks by k - 1."""
    n = len(items) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= ROOT
        out += items[i : i + n]
    return mix(out)


def prepare(spark: SparkSession) -> None:
    """Workers that find the package, and Arrow batches of a size for texts unless one is set."""
    show_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))


def with_longs(schema: T.StructType, *names: str) -> T.StructType:
    """A copy of the schema with more long columns."""
    return T.StructType([*schema.fields, *[T.StructField(n, T.LongType()) for n in names]])


def text_key(text_col: str) -> Column:
    """The SHA-256 of a text, null as empty: copies share it."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
