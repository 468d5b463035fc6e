"""Repeated passages of two or more lines, removed after the first document that has them.

A rolling hash over the hashes of neighbouring lines cuts every text into chunks, at places that inserted
or deleted lines do not shift. A chunk that stands in an earlier document too goes as a whole; from there a
match is extended line by line, and shorter passages are found at all, by every two neighbouring lines.
Digests only propose: what an earlier document has is fetched from it and compared byte by byte with what
is to be removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import blocks, with_longs
from ledgerlark.llm.lines import chunk_spans, line_spans, owner_of
from ledgerlark.session import written

#: Bytes of the digest that proposes equal lines.
DIGEST_BYTES = 16
#: Lines of a chunk, at least; shorter ones are what the pairs find.
CHUNK_LINES = 3
SENT_ROWS = 50_000
SENT_BYTES = 8 << 20


def row_key(text_col: str) -> Column:
    """Tells rows with one id apart; that it is no more than a hash cannot remove wrong lines."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def row_lines(column: pa.Array) -> Iterator[tuple[int, bytes, list[int], list[int], list[tuple[int, int]]]]:
    """(row, text, starts of its lines, their ends, its longer chunks as (first line, lines)) of each text."""
    for row, data, offsets in blocks(column):
        owner, starts, ends = line_spans(data, offsets)
        own_chunk, first, _, lines = chunk_spans(data, offsets)
        raw, cuts = data.tobytes(), offsets.tolist()
        before = np.searchsorted(owner, np.arange(len(cuts))).tolist()
        chunk_before = np.searchsorted(own_chunk, np.arange(len(cuts))).tolist()
        line_of = np.cumsum(lines) - lines
        starts, ends = starts.tolist(), ends.tolist()
        line_of, lines = line_of.tolist(), lines.tolist()
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            own, mine = slice(before[i], before[i + 1]), slice(chunk_before[i], chunk_before[i + 1])
            chunks = [(at - before[i], n) for at, n in zip(line_of[mine], lines[mine]) if n >= CHUNK_LINES]
            yield row + i, raw[a:b], [s - a for s in starts[own]], [e - a for e in ends[own]], chunks


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded length and bytes."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(out) >= SENT_ROWS or size >= SENT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)


PLACE = [("at", pa.int32()), ("lines", pa.int32()), ("digest", pa.binary())]


def spans(texts: DataFrame) -> DataFrame:
    """(owner, key, at, lines, digest) of (owner, key, text): each chunk and each two neighbouring lines."""
    schema = pa.schema([("owner", pa.int64()), ("key", pa.int64()), *PLACE])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            owners, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, raw, starts, ends, chunks in row_lines(batch.column(2)):
                for at, n in [*((i, 2) for i in range(len(starts) - 1)), *chunks]:
                    digest = hashlib.blake2b(raw[starts[at] : ends[at + n - 1]], digest_size=DIGEST_BYTES).digest()
                    yield owners[row], keys[row], at, n, digest

    return texts.mapInArrow(lambda batches: batches_of(found(batches), schema), "owner long, key long, at int, lines int, digest binary")


def uncovered(places: DataFrame) -> DataFrame:
    """(owner, key, at, lines, digest) of (owner, key, places): without the pairs that lie in a chunk of the places."""
    schema = pa.schema([("owner", pa.int64()), ("key", pa.int64()), *PLACE])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for owner, key, own in zip(*(c.to_pylist() for c in batch.columns)):
                until = 0
                # By first line, longer ones first; chunks do not overlap.
                for p in sorted(own, key=lambda p: (p["at"], -p["lines"])):
                    if p["lines"] > 2:
                        until = p["at"] + p["lines"]
                    if p["lines"] > 2 or p["at"] + 2 > until:
                        yield owner, key, p["at"], p["lines"], p["digest"]

    return places.mapInArrow(lambda batches: batches_of(found(batches), schema), "owner long, key long, at int, lines int, digest binary")


def bytes_of(texts: DataFrame) -> DataFrame:
    """(digest, content) of (text, places): the bytes that stand at the places."""
    schema = pa.schema([("digest", pa.binary()), ("content", pa.binary())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            places = batch.column(1)
            for row, raw, starts, ends, _ in row_lines(batch.column(0)):
                for p in places[row].as_py():
                    last = p["at"] + p["lines"] - 1
                    if last < len(starts):
                        yield p["digest"], raw[starts[p["at"]] : ends[last]]

    return texts.mapInArrow(lambda batches: batches_of(found(batches), schema), "digest binary, content binary")


def repeats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(owner, key, marks): for each text the places (at, content) whose content an earlier document keeps."""
    rows = docs.select(owner_of(id_col).alias("owner"), row_key(text_col).alias("key"), F.col(text_col).alias("text"))
    shared = (
        spans(rows)
        .groupBy("digest")
        .agg(F.min("owner").alias("keeper"), F.max("owner").alias("latest"))
        .where("keeper <> latest")
        .select("digest", "keeper")
    )
    # Tables that hot digests are looked up in are written: then a join has a shuffle of its own on either
    # side and a hot one can be split.
    shared = written(shared, "line-shared")
    places = written(spans(rows).join(shared, "digest"), "line-places")
    place = F.collect_set(F.struct("at", "lines", "digest")).alias("places")
    wanted = written(uncovered(places.where("owner <> keeper").groupBy("owner", "key").agg(place)), "line-wanted")
    needed = written(wanted.select("digest").distinct(), "line-needed")
    kept = places.where("owner = keeper").join(needed, "digest", "left_semi").groupBy("owner", "key").agg(place)
    contents = bytes_of(rows.dropDuplicates(["owner", "key"]).join(kept, ["owner", "key"]).select("text", "places"))
    contents = written(contents.groupBy("digest").agg(F.first("content").alias("content")), "line-contents")
    return (
        wanted.join(contents, "digest")
        .groupBy("owner", "key")
        .agg(F.collect_list(F.struct("at", "content")).alias("marks"))
    )


def without(raw: bytes, starts: list[int], ends: list[int], marks: list[dict]) -> tuple[bytes, int]:
    """The text without the marked lines, where they are what the mark says, and without its own later
    copies of two lines; lines removed."""
    gone, first = bytearray(len(starts)), {}
    for mark in marks:
        at, content = mark["at"], mark["content"]
        last = at + content.count(b"\n")
        if last < len(starts) and raw[starts[at] : ends[last]] == content:
            for i in range(at, last + 1):
                gone[i] = 1
    for at, (s, e) in enumerate(zip(starts, ends[1:])):
        # A copy that shares a line with the first one ("same" three times over) is none.
        if at - first.setdefault(raw[s:e], at) >= 2:
            gone[at] = gone[at + 1] = 1
    return b"\n".join([raw[s:e] for s, e, g in zip(starts, ends, gone) if not g]), sum(gone)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_only: bool = False) -> DataFrame:
    """Documents without the passages of two or more lines that an earlier document, or an earlier place
    in the same one, has.

    A line goes if it and a neighbour of it stand next to each other before. Of every removed line a copy
    stays, in the document with the smallest id that has the two lines or in an earlier one still. Rows
    that share an id count as one document and all keep a passage; a null id comes last. A line that is
    repeated without either neighbour is never removed; blank lines are lines. A null text stays null and
    has no lines, an empty one has one; a text whose lines are all elsewhere becomes empty. A very long
    text is cut into lines as a whole, in memory a few times its size. An empty table gives none. Returns
    ``docs`` with the text replaced and ``n_lines``, ``n_removed`` added (over columns of these names), or
    only (doc_id, n_lines, n_removed, kept_sha256).
    """
    found = repeats(docs, id_col, text_col)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    base = docs.select(id_col, text_col) if digest_only else docs.select(*[f"`{c}`" for c in names])
    joined = (
        base.withColumns({"__owner": owner_of(id_col), "__key": row_key(text_col)})
        .join(found.select(F.col("owner").alias("__owner"), F.col("key").alias("__key"), F.col("marks").alias("__marks")), ["__owner", "__key"], "left")
        .drop("__owner", "__key")
    )
    at, out_names = base.columns.index(text_col), [*base.columns, "n_lines", "n_removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, null = batch.column(len(batch.columns) - 1).to_pylist(), batch.column(at).is_null().to_pylist()
            texts, lines, removed = [], [], []
            for row, raw, starts, ends, _ in row_lines(batch.column(at)):
                kept, fewer = without(raw, starts, ends, marks[row] or ())
                texts.append(None if null[row] else hashlib.sha256(kept).hexdigest() if digest_only else kept.decode())
                lines.append(0 if null[row] else len(starts))
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
