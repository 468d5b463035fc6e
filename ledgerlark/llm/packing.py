"""Token pieces in sequences of fixed length, by a grouping genetic algorithm on islands.

Pieces are dealt into cells of bounded size. Each cell evolves on several islands at once, every island
a Spark group; after an epoch the best packing of an island migrates to the next one of its cell.
"""

from __future__ import annotations

import random
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlark.llm.bpe import Chunks, byte_characters
from ledgerlark.llm.common import blocks
from ledgerlark.session import written

CAPACITY = 2048
CELL_PIECES = 2048
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 4

#: Chunks of these characters are in normal form and lower-cased one character at a time.
PLAIN = re.compile(r"[!-~¡-ÿ]*")
#: The tokenizer's split, as it falls on lower-case plain chunks.
PLAIN_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

Bins = list[list[int]]


@lru_cache(maxsize=1)
def chunk_ids(path: str) -> Chunks:
    tokenizer = Tokenizer.from_file(path)
    # Strings of added tokens in a text are these tokens; they hold no white space.
    added = [token.content.lower() for token in tokenizer.get_added_tokens_decoder().values()]

    def encode(chunk: str) -> bytes:
        ids = tokenizer.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_word(word: str) -> bytes:
        ids = [token.id for token in tokenizer.model.tokenize(word.encode().decode("latin-1").translate(mapping))]
        return struct.pack(f"<{len(ids)}I", *ids)

    mapping, words = byte_characters(), Chunks(encode_word)
    parts = PLAIN_PARTS.findall

    def encode_chunk(chunk: str) -> bytes:
        """Plain chunks go part by part to the tokenizer's model, with fewer distinct words to know."""
        if not (chunk.isascii() and chunk.isprintable()) and not PLAIN.fullmatch(chunk):
            return encode(chunk)
        if any(content in chunk.lower() for content in added):
            return encode(chunk)
        if chunk.isalpha():
            return words[chunk.lower()]
        if chunk[:-1].isalpha():
            return words[chunk[:-1].lower()] + words[chunk[-1]]
        return b"".join(map(words.__getitem__, parts(chunk.lower())))

    return Chunks(encode_chunk)


def token_ids(text: str, chunks: Chunks) -> bytes:
    """The text's ids; the tokenizer drops white space first, so texts are cut at it."""
    return b"".join(map(chunks.__getitem__, text.replace("\n", " ").split(" ")))


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and a closing 0, cut after every ``capacity`` ids: one row per piece."""
    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    kinds += [("ids", pa.binary())] * with_ids
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_ids(tokenizer)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, data, offsets in blocks(batch.column(1)):
                raw, ends, out = data.tobytes(), offsets.tolist(), []
                for name, a, b in zip(names[row:], ends, ends[1:]):
                    ids = memoryview(token_ids(raw[a:b].decode(), chunks) + bytes(4))
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out.append((name, i, at // 4, len(part) // 4, zlib.crc32(part), *[bytes(part)] * with_ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(run, kind)


def best_fit(items: list[int], sizes: list[int], bins: Bins, capacity: int) -> Bins:
    """Put items, in the given order, into the bin with the least room that holds them."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for name, members in enumerate(bins):
        if room := capacity - sum(sizes[i] for i in members):
            rooms[room].append(name)
            mask |= 1 << room
    for item in items:
        size = sizes[item]
        if open_rooms := mask >> size:
            room = size + (open_rooms & -open_rooms).bit_length() - 1
            name = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
            bins[name].append(item)
            room -= size
        else:
            name, room = len(bins), capacity - size
            bins.append([item])
        if room:
            rooms[room].append(name)
            mask |= 1 << room
    return bins


def fitness(bins: Bins, sizes: list[int]) -> tuple[int, int]:
    """Smaller is better: number of bins, then fuller bins beside emptier ones."""
    return len(bins), -sum(sum(sizes[i] for i in b) ** 2 for b in bins)


def crossover(mother: Bins, father: Bins, sizes: list[int], capacity: int, draw: random.Random) -> Bins:
    """Inject well-filled bins of the father; the mother's bins that share an item go, their other items are
    put back best fit, largest first."""
    full = sorted(father, key=lambda b: -sum(sizes[i] for i in b))
    full = full[: max(1, len(full) // 2)]
    injected = draw.sample(full, draw.randint(1, len(full)))
    taken = {i for b in injected for i in b}
    kept, displaced = [list(b) for b in injected], []
    for b in mother:
        if taken.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    # The emptiest bin is dissolved too, so that a bin can be saved.
    loosest = min(range(len(kept)), key=lambda k: sum(sizes[i] for i in kept[k]))
    displaced += kept.pop(loosest)
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, kept, capacity)


def evolve(population: list[Bins], sizes: list[int], capacity: int, draw: random.Random, generations: int) -> list[Bins]:
    """The population after some generations, best first; stops early at the lower bound."""
    least = -(-sum(sizes) // capacity)
    scored = sorted(((fitness(b, sizes), b) for b in population), key=lambda x: x[0])
    for _ in range(generations):
        if scored[0][0][0] == least:
            break
        for _ in range(len(scored)):
            mother, father = draw.sample(range(len(scored)), 2) if len(scored) > 1 else (0, 0)
            child = crossover(scored[mother][1], scored[father][1], sizes, capacity, draw)
            score = fitness(child, sizes)
            if score < scored[-1][0]:
                scored[-1] = (score, child)
                scored.sort(key=lambda x: x[0])
    return [b for _, b in scored]


def founders(sizes: list[int], capacity: int, draw: random.Random, count: int) -> list[Bins]:
    """Best fit decreasing, and best fit over orders that are decreasing but for some noise."""
    largest_first = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    out = [best_fit(largest_first, sizes, [], capacity)]
    for _ in range(count - 1):
        noisy = sorted(range(len(sizes)), key=lambda i: -sizes[i] * draw.uniform(0.8, 1.2))
        out.append(best_fit(noisy, sizes, [], capacity))
    return out


def of_rows(rank: pd.DataFrame, place: dict[int, int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for at, b in zip(rank["at"], rank["bin"]):
        bins.setdefault(b, []).append(place[at])
    return list(bins.values())


def island_epoch(capacity: int, epoch: int, population: int, generations: int, elites: int):
    """For applyInPandas on (cell, island): rows of one or several packings in, the ``elites`` best out."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        items = rows.drop_duplicates("at").sort_values("at")
        ats, sizes = items["at"].tolist(), items["length"].tolist()
        cell, island = int(rows["cell"].iloc[0]), int(rows["island"].iloc[0])
        draw = random.Random(f"{cell} {island} {epoch}")
        if epoch == 0:
            known = founders(sizes, capacity, draw, population)
        else:
            place = {at: i for i, at in enumerate(ats)}
            known = [of_rows(x, place) for _, x in rows.groupby("packing")]
        best = evolve(known, sizes, capacity, draw, generations)[:elites]
        out = [
            (cell, island, rank, ats[i], sizes[i], b, len(bins))
            for rank, bins in enumerate(best) for b, members in enumerate(bins) for i in members
        ]
        return pd.DataFrame(out, columns=["cell", "island", "packing", "at", "length", "bin", "bins"])

    return run


ISLAND = "cell long, island int, packing int, at long, length long, bin int, bins int"


def pack_pieces(
    cut: DataFrame, capacity: int = CAPACITY, cell_pieces: int = CELL_PIECES, islands: int = ISLANDS,
    epochs: int = EPOCHS, population: int = POPULATION, generations: int = GENERATIONS,
) -> DataFrame:
    """Piece rows with ``sequence_id`` and ``offset``; a sequence holds at most ``capacity`` ids.

    Full pieces are sequences by themselves. Rows are told apart by their place in a written table, so
    repeated and null ids are no matter. Equal lengths are ties that any order may break.
    """
    cut = written(cut.withColumn("__at", F.monotonically_increasing_id()), "pack-pieces")
    small = cut.where(F.col("length") < capacity).select(F.col("__at").alias("at"), "length")
    cells = max(1, -(-small.count() // cell_pieces))
    dealt = small.select(
        F.pmod(F.xxhash64("at"), F.lit(cells)).alias("cell"),
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.lit(0).alias("packing"), "at", "length", F.lit(0).alias("bin"), F.lit(0).alias("bins"),
    )
    state = dealt
    for epoch in range(epochs):
        last = epoch == epochs - 1
        work = island_epoch(capacity, epoch, population, generations, 1 if last else max(2, population // 2))
        state = written(state.groupBy("cell", "island").applyInPandas(work, ISLAND), "pack-epoch")
        if not last:  # the elite of each island also goes to the next island of its cell
            migrants = state.where("packing = 0").withColumns(
                {"island": F.expr(f"CAST((island + 1) % {islands} AS INT)"), "packing": F.lit(population)}
            )
            state = state.unionByName(migrants) if islands > 1 else state
    best = state.groupBy("cell").agg(F.min(F.struct("bins", "island")).alias("best"))
    best = best.select("cell", F.col("best.island").alias("island"))
    placed = state.join(best, ["cell", "island"]).selectExpr(
        "at AS __at",
        "cell * 4294967296 + bin AS sequence_id",
        "coalesce(sum(length) OVER (PARTITION BY cell, bin ORDER BY at "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offset",
    )
    full = cut.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": -F.col("__at") - 1, "offset": F.lit(0).cast("long")}
    )
    packed = cut.where(F.col("length") < capacity).join(placed, "__at")
    return packed.unionByName(full).drop("__at")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents (null text: empty, its closing 0 alone) with their place in a sequence.

    An empty table gives an empty result. Very long texts become many full pieces; extra columns are not
    read.
    """
    return pack_pieces(pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), capacity)
