"""Repeated multi-line chunks, cut by content and removed after the first document that has them.

A rolling hash over the hashes of neighbouring lines chooses where a chunk ends, so inserted or deleted
lines move no boundary beyond their neighbours. Chunks are grouped by their bytes, not by a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import blocks, sequence_hashes, text_key, with_longs, word_hashes
from ledgerlark.session import written

#: A chunk ends after a line when the hash of it and the line before it is 0 modulo this.
DIVISOR = 4
MAX_LINES = 64
MIN_LINES = 2
NO_ID = (1 << 63) - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every line of a block, line breaks not included; an empty text is one line."""
    breaks = np.flatnonzero(data == 10)
    counts = np.diff(np.searchsorted(breaks, offsets)) + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.append(starts[1:] - 1, len(data))
    last = np.cumsum(counts) - 1
    ends[last] = offsets[1:]
    return owner, starts, ends


def chunk_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first byte, end byte and number of lines of every chunk of a block, in order."""
    owner, starts, ends = line_spans(data, offsets)
    if not len(owner):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    pair = sequence_hashes(word_hashes(data, starts, ends), 2)
    final = np.ones(len(owner), bool)
    final[:-1] = owner[:-1] != owner[1:]
    cut = final.copy()
    cut[1:] |= (pair % np.uint64(DIVISOR) == 0) & (owner[1:] == owner[:-1])
    first = np.flatnonzero(np.append(True, cut[:-1]))
    number = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    cut |= number % MAX_LINES == MAX_LINES - 1
    last = np.flatnonzero(cut)
    first = np.append(0, last[:-1] + 1)
    return owner[first], starts[first], ends[last], last - first + 1


def row_chunks(column: pa.Array) -> Iterator[tuple[int, bytes, list[tuple[int, int, int]]]]:
    """(row, text, its chunks as (start, end, lines)) of each text."""
    for row, data, offsets in blocks(column):
        owner, start, end, lines = chunk_spans(data, offsets)
        raw, ends = data.tobytes(), offsets.tolist()
        before = np.searchsorted(owner, np.arange(len(ends))).tolist()
        spans = list(zip(start.tolist(), end.tolist(), lines.tolist()))
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            yield row + i, raw[a:b], [(s - a, e - a, n) for s, e, n in spans[before[i] : before[i + 1]]]


def multi_line_chunks(texts: DataFrame) -> DataFrame:
    """(owner, chunk) rows of (owner, text): each chunk of two or more lines once for a text."""
    schema = pa.schema([("owner", pa.int64()), ("chunk", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, names, chunks, size = batch.column(0).to_pylist(), [], [], 0
            for row, raw, spans in row_chunks(batch.column(1)):
                seen = {raw[s:e] for s, e, n in spans if n >= MIN_LINES}
                names += [owners[row]] * len(seen)
                chunks += seen
                size += len(raw)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(chunks, pa.binary())], schema=schema)
                    names, chunks, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(chunks, pa.binary())], schema=schema)

    return texts.mapInArrow(run, "owner long, chunk binary")


def chunk_digests(texts: DataFrame) -> DataFrame:
    """(owner, key, digest) rows of (owner, key, text), one for each multi-line chunk of a text."""
    schema = pa.schema([("owner", pa.int64()), ("key", pa.binary()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, keys, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for row, raw, spans in row_chunks(batch.column(2)):
                seen = {raw[s:e] for s, e, n in spans if n >= MIN_LINES}
                out += [(owners[row], keys[row], hashlib.sha256(c).digest()) for c in seen]
            columns = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    return texts.mapInArrow(run, "owner long, key binary, digest binary")


def owner_of(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(owner, key, digests): for each text the chunks that an earlier document keeps."""
    rows = docs.select(owner_of(id_col).alias("owner"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    # Grouped by the bytes themselves; a chunk that many documents share is one row per task here.
    shared = (
        multi_line_chunks(rows.select("owner", "text"))
        .groupBy("chunk")
        .agg(F.min("owner").alias("keeper"), F.max("owner").alias("latest"))
        .where("keeper <> latest")
        .select(F.unhex(F.sha2("chunk", 256)).alias("digest"), "keeper")
    )
    # Written, so that the join has a shuffle of its own on either side and a hot chunk can be split.
    shared = written(shared, "line-chunks")
    return (
        chunk_digests(rows)
        .join(shared, "digest")
        .where("owner <> keeper")
        .groupBy("owner", "key")
        .agg(F.collect_set("digest").alias("digests"))
    )


def without(raw: bytes, spans: list[tuple[int, int, int]], gone: set[bytes]) -> tuple[bytes, int]:
    """The text without the chunks named in ``gone`` and without its own later copies; lines removed."""
    kept, seen, removed = [], set(), 0
    for start, end, lines in spans:
        chunk = raw[start:end]
        if lines >= MIN_LINES and (chunk in seen or gone and hashlib.sha256(chunk).digest() in gone):
            removed += lines
            continue
        seen.add(chunk)
        kept.append(chunk)
    return b"\n".join(kept), removed


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_only: bool = False) -> DataFrame:
    """Documents without multi-line chunks that an earlier document, or an earlier place in the same one, has.

    The document with the smallest id keeps a chunk; rows that share an id count as one document and all
    keep it, a null id comes last. A null text stays null and has no lines, an empty one has one. Single
    lines are never removed; a text whose chunks are all elsewhere becomes empty. Returns ``docs`` with
    the text replaced and ``n_lines``, ``n_removed`` added (over columns of these names), or only
    (doc_id, n_lines, n_removed, kept_sha256).
    """
    gone = repeats(docs, id_col, text_col)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    base = docs.select(id_col, text_col) if digest_only else docs.select(*[f"`{c}`" for c in names])
    joined = (
        base.withColumns({"__owner": owner_of(id_col), "__key": text_key(text_col)})
        .join(gone.select(F.col("owner").alias("__owner"), F.col("key").alias("__key"), F.col("digests").alias("__gone")), ["__owner", "__key"], "left")
        .drop("__owner", "__key")
    )
    at, out_names = base.columns.index(text_col), [*base.columns, "n_lines", "n_removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone_of, null = batch.column(len(batch.columns) - 1).to_pylist(), batch.column(at).is_null().to_pylist()
            texts, lines, removed = [], [], []
            for row, raw, spans in row_chunks(batch.column(at)):
                kept, fewer = without(raw, spans, set(gone_of[row] or ()))
                texts.append(None if null[row] else hashlib.sha256(kept).hexdigest() if digest_only else kept.decode())
                lines.append(0 if null[row] else sum(n for _, _, n in spans))
                removed.append(fewer)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lines, pa.int64()), pa.array(removed, pa.int64())],
                names=out_names,
            )

    out = joined.mapInArrow(run, with_longs(base.schema, "n_lines", "n_removed"))
    if not digest_only:
        return out
    return out.select(F.col(id_col).alias("doc_id"), "n_lines", "n_removed", F.col(text_col).alias("kept_sha256"))
