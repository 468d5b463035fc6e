"""Document quality by a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees learns one lookup table per text feature and one per chosen pair of
features; a score is a sum of table entries. The model is fitted on a bounded sample of labelled rows,
every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import blocks, mix, sequence_hashes, word_hashes, word_spans

#: Labelled rows that the model is fitted on, at most: those with the smallest hash of the id.
SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 40
RATE = 0.15
LEAF_ROWS = 5

#: Byte classes that features count.
CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "space": b" ",
    "line": b"\n",
    "stop": b".,;:",
    "shout": b"!?",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "quote": b"\"'()-",
}
FEATURES = (
    *CLASSES, "bytes", "words", "word_length", "longest_word", "distinct_words", "distinct_runs",
    "top_word", "short_words", "distinct_lines", "line_length",
)


def class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.uint8)
    for i, members in enumerate(CLASSES.values()):
        table[list(members)] = i
    return table


CLASS_OF = class_table()


def distinct_by_row(row: np.ndarray, values: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of distinct values and the count of the commonest one."""
    key = mix(values ^ mix(row.astype(np.uint64) + np.uint64(1)))
    kinds, first, counts = np.unique(key, return_index=True, return_counts=True)
    owner = row[first]
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, owner, counts)
    return np.bincount(owner, minlength=rows), top


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text of a block; an empty text has zeros."""
    rows = len(offsets) - 1
    out = np.zeros((rows, len(FEATURES)))
    size = np.diff(offsets)
    kinds = CLASS_OF[data]
    at = {name: i for i, name in enumerate(FEATURES)}
    for i, name in enumerate(CLASSES):
        places = np.flatnonzero(kinds == i)
        out[:, i] = np.diff(np.searchsorted(places, offsets)) / np.maximum(size, 1)
    starts, ends, before = word_spans(data, offsets)
    words = np.diff(before)
    owner = np.repeat(np.arange(rows), words)
    lengths = ends - starts
    hashes = word_hashes(data, starts, ends)
    many = np.maximum(words, 1)
    out[:, at["bytes"]] = np.log1p(size)
    out[:, at["words"]] = np.log1p(words)
    out[:, at["word_length"]] = np.bincount(owner, lengths, rows) / many
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, owner, lengths)
    out[:, at["longest_word"]] = np.log1p(longest)
    kinds_of, top = distinct_by_row(owner, hashes, rows)
    out[:, at["distinct_words"]] = kinds_of / many
    out[:, at["top_word"]] = top / many
    out[:, at["short_words"]] = np.bincount(owner[lengths <= 3], minlength=rows) / many
    runs = sequence_hashes(hashes, 3)
    inside = owner[2:] == owner[: len(runs)] if len(runs) else np.zeros(0, bool)
    run_owner = owner[: len(runs)][inside]
    run_kinds, _ = distinct_by_row(run_owner, runs[inside], rows)
    out[:, at["distinct_runs"]] = run_kinds / np.maximum(np.bincount(run_owner, minlength=rows), 1)
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1][size > 0], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_owner = np.searchsorted(offsets, line_start, "right") - 1
    first_word = np.searchsorted(starts, line_start)
    last_word = np.append(first_word[1:], len(starts))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes), out=sums[1:])
    line_hash = sums[last_word] - sums[first_word]
    full = last_word > first_word
    line_kinds, _ = distinct_by_row(line_owner[full], line_hash[full], rows)
    lines = np.bincount(line_owner[full], minlength=rows)
    out[:, at["distinct_lines"]] = line_kinds / np.maximum(lines, 1)
    out[:, at["line_length"]] = np.log1p(size / np.maximum(lines, 1))
    return out


def batch_features(texts: pa.Array) -> np.ndarray:
    parts = [features(data, offsets) for _, data, offsets in blocks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Model:
    edges: list[np.ndarray]
    tables: np.ndarray  # feature, bin
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: np.ndarray  # pair, bin of the first, bin of the second
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, edges in enumerate(self.edges):
            total += self.tables[f, np.searchsorted(edges, x[:, f], "right")]
        for p, (f, g) in enumerate(self.pairs):
            i = np.searchsorted(self.pair_edges[f], x[:, f], "right")
            total += self.pair_tables[p, i, np.searchsorted(self.pair_edges[g], x[:, g], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """At most bins - 1 edges at quantiles, between different values."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def step(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """A shallow tree over ordered bins: the leaf's Newton step for every bin."""
    out = np.full(len(gradient), gradient.sum() / (weight.sum() + 1.0))
    if depth == 0 or len(gradient) < 2:
        return out
    g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    gain = g**2 / (w + 1.0) + (gradient.sum() - g) ** 2 / (weight.sum() - w + 1.0)
    gain[(w < LEAF_ROWS * 0.05) | (weight.sum() - w < LEAF_ROWS * 0.05)] = -1
    cut = int(np.argmax(gain)) + 1
    if gain[cut - 1] <= gradient.sum() ** 2 / (weight.sum() + 1.0):
        return out
    out[:cut] = step(gradient[:cut], weight[:cut], depth - 1)
    out[cut:] = step(gradient[cut:], weight[cut:], depth - 1)
    return out


def pair_step(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of depth two over a grid: one cut of one feature, then one cut of the other on either side."""
    best, most = np.zeros_like(gradient), -1.0
    for flip in (False, True):
        g, w = (gradient.T, weight.T) if flip else (gradient, weight)
        for cut in range(1, len(g)):
            out = np.empty_like(g)
            out[:cut] = step(g[:cut].sum(0), w[:cut].sum(0), 1)
            out[cut:] = step(g[cut:].sum(0), w[cut:].sum(0), 1)
            gain = float((out * g).sum())
            if gain > most:
                best, most = out.T if flip else out, gain
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: every round visits each feature, then rounds that visit the chosen pairs.

    Without labels every score is 0.5; with one class it is near that class.
    """
    n, width = len(y), len(FEATURES)
    edges = [cut_points(x[:, f], BINS) for f in range(width)]
    pair_edges = [cut_points(x[:, f], PAIR_BINS) for f in range(width)]
    share = (y.sum() + 0.5) / (n + 1.0)
    model = Model(edges, np.zeros((width, BINS)), [], pair_edges, np.zeros((0, PAIR_BINS, PAIR_BINS)), float(np.log(share / (1 - share))))
    if n == 0 or y.min() == y.max():
        return model
    bins = [np.searchsorted(edges[f], x[:, f], "right") for f in range(width)]
    total = np.full(n, model.base)
    for _ in range(ROUNDS):
        for f in range(width):
            p = 1 / (1 + np.exp(-total))
            change = RATE * step(np.bincount(bins[f], y - p, BINS), np.bincount(bins[f], p * (1 - p), BINS), 2)
            model.tables[f] += change
            total += change[bins[f]]
    coarse = [np.searchsorted(pair_edges[f], x[:, f], "right") for f in range(width)]
    cells = PAIR_BINS * PAIR_BINS
    p = 1 / (1 + np.exp(-total))
    gains = []
    for f in range(width):
        for g in range(f + 1, width):
            cell = coarse[f] * PAIR_BINS + coarse[g]
            gradient, weight = np.bincount(cell, y - p, cells), np.bincount(cell, p * (1 - p), cells)
            gains.append((float((gradient**2 / (weight + 1.0)).sum()), f, g))
    model.pairs = [(f, g) for _, f, g in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = np.zeros((len(model.pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(model.pairs):
            p = 1 / (1 + np.exp(-total))
            cell = coarse[f] * PAIR_BINS + coarse[g]
            grid = (PAIR_BINS, PAIR_BINS)
            change = RATE * pair_step(
                np.bincount(cell, y - p, cells).reshape(grid),
                np.bincount(cell, p * (1 - p), cells).reshape(grid),
            )
            model.pair_tables[k] += change
            total += change.ravel()[cell]
    return model


def held_out(id_col: str):
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of ``quality`` labels, from at most ``rows`` labelled documents that are not held out.

    Null labels and ids are left out; of contrary labels for an id the larger one holds. A repeated id
    brings each of its rows.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max("quality").alias("__quality"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch_features(batch.column(1))
            ids, label = batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32())
            columns = [pa.array(x[:, f]) for f in range(x.shape[1])]
            yield pa.RecordBatch.from_arrays([ids, label, *columns], names=["id", "y", *FEATURES])

    kind = "id long, y int, " + ", ".join(f"`{f}` double" for f in FEATURES)
    # A broadcast of at most ``rows`` pairs of numbers; the collected sample has as many rows.
    sample = texts.join(F.broadcast(known), "__id").mapInArrow(run, kind)
    sample = sample.orderBy("id", *FEATURES).limit(rows).toPandas()
    return fit(sample[list(FEATURES)].to_numpy(float), sample["y"].to_numpy(float))


def score_of(model: Model, text_col: str) -> Column:
    """The probability of label 1; a null text is an empty one. Only texts go to the workers."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(batch_features(texts)))

    return run(F.coalesce(F.col(text_col), F.lit("")))


def predict(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; the model sees texts only."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), score_of(model, text_col).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with their own columns."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    return docs.where(score_of(model, text_col) >= 0.5)
