"""Windows of words that stand more than once in a corpus, by super-k-mer partitioning.

Every window has a minimiser, the smallest hash of its short word runs. Consecutive windows with the
same one travel as one packed string to the minimiser's bucket, where equal windows are counted exactly
by sorting. A minimiser that the corpus has once cannot belong to a repeated window, so its strings
stay where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import blocks, sequence_hashes, text_key, with_longs, word_hashes, word_spans
from ledgerlark.session import written

WINDOW = 35
GRAM = 6
#: Bytes of the strings in a bucket, about; strings of one minimiser before its windows are dealt one by one.
BUCKET_BYTES = 2 << 20
HEAVY_STRINGS = 2_000
#: Places of a string in one row, and bytes of the strings that a task holds before it sends them.
PLACES = 1_000
STRING_BYTES = 8 << 20
POSITION_BITS = np.uint64((1 << 24) - 1)
PIECE_WORDS = 1 << 23


def super_kmers(hashes: np.ndarray, before: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows (at most window - gram + 1) and minimiser of every super-k-mer.

    ``before``: where each text's words start. Ties between equal hashes go to the leftmost.
    """
    parts = []
    for piece in range(0, max(len(hashes) - window + 1, 0), PIECE_WORDS):
        own = hashes[piece : piece + PIECE_WORDS + window - 1]
        grams = sequence_hashes(own, gram)
        least = (grams & ~POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
        width, have = window - gram + 1, 1
        while have < width:
            move = min(have, width - have)
            least = np.minimum(least[:-move], least[move:])
            have += move
        place = (least & POSITION_BITS).astype(np.int64)
        start = np.arange(piece, piece + len(place))
        text = np.searchsorted(before, start, "right") - 1
        whole = start + window <= before[np.minimum(text + 1, len(before) - 1)]
        new = whole.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~whole[:-1]
        first = np.flatnonzero(new)
        running = np.cumsum(whole)
        total = running[-1] if len(running) else 0
        windows = np.diff(np.append(running[first] - 1, total))
        parts.append((first + piece, windows, grams[place[first]].view(np.int64)))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def span_rows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, start, windows, minimiser) of every super-k-mer of (key, text) rows."""
    schema = pa.schema([("key", pa.binary()), ("start", pa.int32()), ("windows", pa.int32()), ("minimiser", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column(1)):
                starts, ends, before = word_spans(data, offsets)
                first, windows, minimiser = super_kmers(word_hashes(data, starts, ends), before, window, gram)
                text = np.searchsorted(before, first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + text)).cast(pa.binary()),
                        pa.array(first - before[text], pa.int32()),
                        pa.array(windows, pa.int32()),
                        pa.array(minimiser),
                    ],
                    schema=schema,
                )

    return texts.mapInArrow(run, "key binary, start int, windows int, minimiser long")


def string_rows(texts: DataFrame, window: int) -> DataFrame:
    """(sid, windows, minimiser, copies, packed, places, lot): words of each span, joined by one space.

    ``texts``: key, text, copies and spans as arrays. A lot is consecutive texts of a task, named by the key of
    its first one; it holds all strings of these texts, about ``STRING_BYTES`` together. Equal strings of a lot are
    one row with the places, (key, start), where they stand; ``places`` has at most ``PLACES`` entries, more make
    another row.
    """
    place = pa.struct([("key", pa.binary()), ("start", pa.int32())])
    kinds = [("sid", pa.binary()), ("windows", pa.int32()), ("minimiser", pa.int64()), ("copies", pa.int64()), ("packed", pa.binary()), ("places", pa.list_(place)), ("lot", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows, full, size, lot = {}, [], 0, None

        def sent() -> pa.RecordBatch:
            nonlocal size, lot
            out = [(*row, lot) for row in (*full, *open_rows.values())]
            size, lot = 0, None
            open_rows.clear()
            full.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            keys, copies, spans = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for row, data, offsets in blocks(batch.column(1)):
                starts, ends, before = word_spans(data, offsets)
                for i in range(len(offsets) - 1):
                    a, b = before[i], before[i + 1]
                    raw = data[offsets[i] : offsets[i + 1]].tobytes()
                    s, e = (starts[a:b] - offsets[i]).tolist(), (ends[a:b] - offsets[i]).tolist()
                    lot = keys[row + i] if lot is None else lot
                    for span in spans[row + i]:
                        at, n = span["start"], span["windows"]
                        packed = raw[s[at] : e[at + n + window - 2]]
                        packed = b" ".join(packed.split())  # bytes split at the same six characters as words
                        own = open_rows.get(packed)
                        if own is None:
                            own = open_rows[packed] = [hashlib.sha256(packed).digest(), n, span["minimiser"], 0, packed, []]
                            size += len(packed)
                        own[3] += copies[row + i]
                        own[5].append((keys[row + i], at))
                        size += 48
                        if len(own[5]) == PLACES:
                            full.append(open_rows.pop(packed))
                    if size > STRING_BYTES:
                        yield sent()
        if size:
            yield sent()

    kind = "sid binary, windows int, minimiser long, copies long, packed binary, places array<struct<key:binary,start:int>>, lot binary"
    return texts.mapInArrow(run, kind)


def ranks(codes: np.ndarray, window: int) -> np.ndarray:
    """A number for each run of ``window`` codes, equal for equal runs: pairs of shorter runs are sorted."""
    have, rank = 1, codes
    while have < window:
        move = min(have, window - have)
        pairs = rank[:-move] * np.int64(len(codes) + 1) + rank[move:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        have += move
    return rank


def count_bucket(window: int):
    """For applyInPandas: marks, bit by bit, the windows of each string that the bucket has more than once."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        codes = pd.factorize(np.array(b" ".join(rows["packed"]).split(b" "), object))[0].astype(np.int64)
        windows = rows["windows"].to_numpy().astype(np.int64)
        words = windows + window - 1
        base = np.cumsum(words) - words
        string = np.repeat(np.arange(len(rows)), windows)
        bit = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
        rank = ranks(codes, window)[base[string] + bit]
        total = np.bincount(rank, rows["copies"].to_numpy()[string])
        again = total[rank] > 1
        mask = np.zeros(len(rows), np.int64)
        np.bitwise_or.at(mask, string[again], np.int64(1) << bit[again])
        return pd.DataFrame({"sid": rows["sid"], "mask": mask})[mask != 0]

    return run


def window_rows(strings: DataFrame, window: int) -> DataFrame:
    """(sid, bit, copies, text) of every single window of the strings."""
    kinds = [("sid", pa.binary()), ("bit", pa.int32()), ("copies", pa.int64()), ("text", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                out = []
                for row in batch.slice(at, 1000).to_pylist():
                    words = row["packed"].split(b" ")
                    out += [(row["sid"], i, row["copies"], b" ".join(words[i : i + window])) for i in range(row["windows"])]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return strings.mapInArrow(run, "sid binary, bit int, copies long, text binary")


def marks_of_lot(rows: pa.Table) -> pa.Table:
    """For applyInArrow: (key, marks) of the lot's texts, from the places and the mask of each string."""
    places = rows["places"].combine_chunks()
    place = pc.list_flatten(places)
    own = pa.table({
        "key": pc.struct_field(place, "key"),
        "start": pc.struct_field(place, "start"),
        "mask": rows["mask"].combine_chunks().take(pc.list_parent_indices(places)),
    })
    # Without threads, so that both lists are in the same order.
    by_key = own.group_by("key", use_threads=False).aggregate([("start", "list"), ("mask", "list")]).combine_chunks()
    starts, masks = by_key["start_list"].combine_chunks(), by_key["mask_list"].combine_chunks()
    marks = pa.StructArray.from_arrays([starts.flatten(), masks.flatten()], names=["start", "mask"])
    ends = np.append(0, np.cumsum(pc.list_value_length(starts).to_numpy(zero_copy_only=False)))
    return pa.table({"key": by_key["key"], "marks": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), marks)})


def repeated_windows(docs: DataFrame, text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, marks): for each different text, by SHA-256, its repeated windows as (start, mask) pairs."""
    texts = docs.select(text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    spans = written(span_rows(texts, window, gram), "substring-spans")
    # Tables that hot keys are looked up in are written: then the join has a shuffle of its own on
    # either side, or none, and Spark can split a hot partition.
    shared = spans.groupBy("minimiser").agg(F.count("*").alias("n")).where("n > 1").select("minimiser")
    shared = written(shared, "substring-shared")
    wanted = (
        spans.join(shared, "minimiser", "left_semi")
        .groupBy("key")
        .agg(F.collect_set(F.struct("start", "windows", "minimiser")).alias("spans"))
    )
    # Copies of a text are combined before the shuffle and travel as one row with a count.
    different = texts.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    placed = different.join(wanted, "key").select("key", "text", "copies", "spans")
    placed = written(string_rows(placed, window), "substring-strings")
    strings = placed.groupBy("sid").agg(
        F.first("packed").alias("packed"), F.first("windows").alias("windows"),
        F.first("minimiser").alias("minimiser"), F.sum("copies").alias("copies"),
    )
    strings = written(strings, "substring-distinct")
    size = strings.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    heavy = strings.groupBy("minimiser").agg(F.count("*").alias("n")).where(F.col("n") > HEAVY_STRINGS)
    # Written, so that Spark sees its size and need not shuffle the strings to look up a few minimisers.
    heavy = written(heavy.select("minimiser"), "substring-heavy")
    light = strings.join(heavy, "minimiser", "left_anti")
    counted = (
        light.select("sid", "packed", "windows", "copies", F.pmod(F.xxhash64("minimiser"), F.lit(buckets)).alias("bucket"))
        .groupBy("bucket")
        .applyInPandas(count_bucket(window), "sid binary, mask long")
    )
    single = written(
        window_rows(
            strings.join(heavy, "minimiser", "left_semi").select("sid", "packed", "windows", "copies"), window
        ),
        "substring-windows",
    )
    again = single.groupBy("text").agg(F.sum("copies").alias("n")).where("n > 1").select("text")
    spread = (
        single.join(again, "text", "left_semi")
        .groupBy("sid")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    )
    repeated = written(counted.unionByName(spread), "substring-masks")
    # A lot has whole texts, so its strings give all marks of a text: places are never a row each.
    marks = (
        placed.select("sid", "places", "lot")
        .join(repeated, "sid")
        .select("lot", "places", "mask")
        .groupBy("lot")
        .applyInArrow(marks_of_lot, "key binary, marks array<struct<start:int,mask:bigint>>")
    )
    return written(marks, "substring-marks")


def covered_words(before: np.ndarray, marks: list, window: int) -> np.ndarray:
    """Which words of a block's texts lie in a marked window."""
    change = np.zeros(before[-1] + 1, np.int64)
    pairs = [(before[i] + m["start"], m["mask"]) for i, own in enumerate(marks) for m in own or ()]
    if pairs:
        start, mask = np.array(pairs, np.int64).T
        which, bit = np.nonzero((mask[:, None] >> np.arange(62)) & 1)
        np.add.at(change, start[which] + bit, 1)
        np.add.at(change, start[which] + bit + window, -1)
    return np.cumsum(change[:-1]) > 0


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> list[bytes]:
    """For each text its words joined by one space."""
    if not len(starts):
        return [b""] * (len(before) - 1)
    lengths = ends - starts + 1
    stop = np.cumsum(lengths)
    index = np.repeat(starts - stop + lengths, lengths) + np.arange(stop[-1])
    out = data[np.minimum(index, len(data) - 1)]
    out[stop - 1] = 0x20
    raw, edge = out.tobytes(), np.append(0, stop)[before].tolist()
    return [raw[a : max(a, b - 1)] for a, b in zip(edge, edge[1:])]


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    gram: int = GRAM, digest_only: bool = False,
) -> DataFrame:
    """Documents without the words of any window that also starts anywhere else in the corpus.

    Texts with fewer words than a window, null and empty ones stay as they are; every row counts, so all
    copies of a text lose their windows. A changed text keeps the white space before its kept words'
    successors; an unchanged one is returned as it is. Returns ``docs`` with the text replaced and
    ``n_words``, ``n_removed`` added (over columns of these names), or only (doc_id, n_words, n_removed,
    kept_sha256), where kept words are joined by one space.
    """
    marks = repeated_windows(docs, text_col, window, gram)
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    base = docs.select(id_col, text_col) if digest_only else docs.select(*[f"`{c}`" for c in names])
    joined = (
        base.withColumn("__key", text_key(text_col))
        .join(marks.select(F.col("key").alias("__key"), F.col("marks").alias("__marks")), "__key", "left")
        .drop("__key")
    )
    at, out_names = base.columns.index(text_col), [*base.columns, "n_words", "n_removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, column = batch.column(len(batch.columns) - 1), batch.column(at)
            for row, data, offsets in blocks(column):
                starts, ends, before = word_spans(data, offsets)
                n = len(offsets) - 1
                gone = covered_words(before, own.slice(row, n).to_pylist(), window)
                kept = np.append(0, np.cumsum(~gone))[before]
                if digest_only:
                    texts = [hashlib.sha256(x).hexdigest() for x in joined_words(data, starts[~gone], ends[~gone], kept)]
                else:
                    texts = column.slice(row, n).to_pylist()
                    raw = data.tobytes()
                    for i in np.flatnonzero(np.diff(kept) < np.diff(before)):
                        a, b = before[i], before[i + 1]
                        until = np.append(starts[a + 1 : b], ends[b - 1 : b])
                        pieces = [raw[s:e] for s, e, g in zip(starts[a:b], until, gone[a:b]) if not g]
                        texts[i] = b"".join(pieces).rstrip(b" \t\n\v\f\r").decode()
                columns = [c.slice(row, n) for c in batch.columns[:-1]]
                columns[at] = pa.array(texts, pa.string())
                words = np.diff(before)
                columns += [pa.array(words), pa.array(words - np.diff(kept))]
                yield pa.RecordBatch.from_arrays(columns, names=out_names)

    out = joined.mapInArrow(run, with_longs(base.schema, "n_words", "n_removed"))
    if not digest_only:
        return out
    return out.select(F.col(id_col).alias("doc_id"), "n_words", "n_removed", F.col(text_col).alias("kept_sha256"))
