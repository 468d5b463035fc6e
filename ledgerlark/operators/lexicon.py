"""Which words of a large lexicon occur in which texts, by looking up the texts' pieces.

A text is cut into its substrings of the lengths that the lexicon has, and these are looked up among the words:
the work grows with the characters of the texts, not with how often pieces of words come up. The words' hashes
set bits in a table of bounded size that every task has; a piece whose bits are not all set is no word and goes no
further, the others travel and are compared with the words themselves. Words longer than a piece are looked up by
their beginning, and one that comes up is searched for in the text itself. Plans are the same for ten words and
for ten million.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.session import show_package, written

#: Characters of the longest pieces.
PIECE = 32
#: Characters of a text in which the pieces of a row begin.
STRETCH = 128
#: Rows whose characters are hashed at once.
BLOCK_ROWS = 256
#: A word sets four bits in one of 2 ** n lanes of 64 bits. There is a lane for four words, but at most 2 ** LANES
#: (64 MB): with more than about 30 million words ever more pieces travel that are no words.
LANES = 23
ROOT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ROOT and of its inverse modulo 2**64."""
    up, down = np.full(n, ROOT), np.full(n, np.uint64(pow(int(ROOT), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Block:
    """Some texts in one, with the places of each."""

    def __init__(self, texts: list[bytes]) -> None:
        parts = [t.decode(errors="surrogateescape") for t in texts]
        self.text = "".join(parts)
        self.bounds = np.cumsum([0, *map(len, parts)])
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        up, self.down = powers(max(1 << 16, 1 << len(codes).bit_length()))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix((codes + np.uint64(1)) * ROOT) * up[: len(codes)], out=self.sums[1:])

    def hashes(self, length: int) -> np.ndarray:
        """A 64-bit hash of the substring of this length that begins at each place, whatever text it ends in."""
        n = max(len(self.sums) - length, 0)
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n] + np.uint64(length))


def in_blocks(texts: pa.Array) -> Iterator[tuple[int, Block]]:
    """(first row, block) of consecutive rows."""
    for row in range(0, len(texts), BLOCK_ROWS):
        yield row, Block(texts.slice(row, BLOCK_ROWS).to_pylist())


def lanes_of(hashes: np.ndarray, power: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - power)).astype(np.int64)


def bit_of(hashes: np.ndarray, i: int) -> np.ndarray:
    """The place in its lane of a hash's i-th bit."""
    return (hashes >> np.uint64(6 * i)) & np.uint64(63)


def word_bits(words: DataFrame, count: int) -> Broadcast:
    """Lanes with the bits that the hashes of (piece) rows set."""
    power = min(max((count // 4).bit_length(), 1), LANES)
    schema = pa.schema([("lane", pa.int32()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in in_blocks(batch.column(0)):
                sizes = np.diff(block.bounds)
                found = np.zeros(len(sizes), np.uint64)
                for n in np.unique(sizes).tolist():
                    found[sizes == n] = block.hashes(n)[block.bounds[:-1][sizes == n]]
                bits = np.zeros(len(found), np.uint64)
                for i in range(4):
                    bits |= np.uint64(1) << bit_of(found, i)
                lanes = lanes_of(found, power).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(lanes), pa.array(bits.view(np.int64))], schema=schema)

    show_package(words.sparkSession)
    rows = words.select(F.col("piece").cast("binary")).mapInArrow(run, "lane int, bits long")
    rows = rows.groupBy("lane").agg(F.bit_or("bits").alias("bits")).toArrow()
    lanes = np.zeros(1 << power, np.uint64)
    lanes[rows.column("lane").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return words.sparkSession.sparkContext.broadcast(lanes)


def text_pieces(texts: DataFrame, keys: list[str], lengths: list[int], words: Broadcast | None = None) -> DataFrame:
    """(keys, piece): the substrings of lower-cased texts in ``_text``, as often as they stand there.

    With the bits of ``words``, only substrings that set no other ones: all that are words, and few more.
    Stretches overlap, so that every piece is whole in the one that it begins in. They are dealt over the
    session's shuffle partitions, as few files with much text are few tasks else.
    """
    starts = F.sequence(F.lit(1), F.length("_text"), F.lit(STRETCH))
    stretches = F.transform(starts, lambda at: F.substring("_text", at, F.lit(STRETCH + PIECE - 1)))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = texts.select(*keys, F.explode(stretches).alias("_stretch")).repartition(parts)
    cut = cut.withColumn("_stretch", F.col("_stretch").cast("binary"))
    schema = T.StructType([*cut.select(*keys).schema.fields, T.StructField("piece", T.BinaryType())])

    def places(block: Block, length: int) -> np.ndarray:
        """Where pieces of this length begin that may be words."""
        if words is None:
            return np.arange(max(len(block.sums) - length, 0))
        hashes = block.hashes(length)
        lanes = words.value[lanes_of(hashes, len(words.value).bit_length() - 1)]
        found = np.flatnonzero((lanes >> bit_of(hashes, 0)) & np.uint64(1))
        for i in range(1, 4):
            found = found[((lanes[found] >> bit_of(hashes[found], i)) & np.uint64(1)).astype(bool)]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.select(batch.schema.names[:-1])
            for row, block in in_blocks(batch.column(batch.num_columns - 1)):
                rows, pieces = [], []
                for n in lengths:
                    at = places(block, n)
                    of = np.searchsorted(block.bounds, at, "right") - 1
                    whole = (at + n <= block.bounds[of + 1]) & (at - block.bounds[of] < STRETCH)
                    rows.append(of[whole] + row)
                    pieces += [block.text[i : i + n].encode(errors="surrogateescape") for i in at[whole].tolist()]
                columns = own.take(pa.array(np.concatenate(rows))).columns
                yield pa.RecordBatch.from_arrays([*columns, pa.array(pieces, pa.binary())], names=schema.names)

    show_package(texts.sparkSession)
    return cut.mapInArrow(run, schema).withColumn("piece", F.col("piece").cast("string"))


def lexicon_matches(
    texts: DataFrame, keys: list[str], text: str, words: DataFrame, word: str = "word"
) -> DataFrame:
    """(keys, word) for every different word that the lower-cased text has as a substring.

    Words are taken as they are: one with capitals is in no text. NULL and empty words are left out, repeated
    ones count once; NULL texts hold nothing. ``keys`` tell the texts apart: of rows that share them each is
    searched, and a word that several have comes out once.
    """
    listed = words.select(F.col(word).alias("word")).where(F.length("word") > 0).distinct()
    listed = written(listed, "lexicon").withColumn("piece", F.substring("word", 1, PIECE))
    counts = dict(listed.groupBy(F.least(F.length("word"), F.lit(PIECE + 1))).count().collect())
    own = texts.where(F.length(text) > 0).select(*keys, F.lower(text).alias("_text"))
    if not counts:
        return own.select(*keys, F.lit(None).cast("string").alias("word")).where(F.lit(False))
    lengths = sorted({min(n, PIECE) for n in counts})
    pieces = text_pieces(own, keys, lengths, word_bits(listed, sum(counts.values())))
    # A semi join: of an inner one Spark might broadcast the pieces, as it takes them for no more than the texts.
    held = pieces.join(listed.select("piece"), "piece", "left_semi").select(*keys, "piece").distinct()
    if max(counts) <= PIECE:
        return held.withColumnRenamed("piece", "word")
    likely = written(written(held, "lexicon-pieces").join(listed, "piece").select(*keys, "word"), "lexicon-likely")
    # Texts travel once, by their keys, to the words that only the beginning is known of.
    begun = own.join(likely.where(F.length("word") > PIECE), keys).where(F.contains("_text", F.col("word")))
    return likely.where(F.length("word") <= PIECE).unionByName(begun.select(*keys, "word").distinct())


def with_toxicity(
    texts: DataFrame, keys: list[str], text: str, words: DataFrame, word: str = "word"
) -> DataFrame:
    """Add ``toxicity_score`` as ``toxicity_score`` of the text functions has it, for a lexicon of any size."""
    counts = lexicon_matches(texts, keys, text, words, word).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    score = F.least(F.coalesce("_n", F.lit(0)) / F.lit(3.0), F.lit(1.0))
    return texts.join(counts, keys, "left").withColumn("toxicity_score", score).drop("_n")
