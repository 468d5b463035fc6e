"""Shards of near equal size from indivisible groups, by best-fit-decreasing bin packing.

Groups are dealt into cells; in every cell they enter pallets, small bins, best fit first. Pallets and
groups too large for one are then packed into the shards the same way. A pallet is a fixed fraction of
a shard, so the second step has a bounded number of items whatever the size of the corpus.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import written

PALLETS_PER_SHARD = 512
CELLS = 256
LEAF = 256


class CapacityTree:
    """Open bins by remaining capacity, in a balanced tree of two levels: leaves split when full."""

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = []
        self.largest: list[tuple[int, int]] = []

    def add(self, room: int, name: int) -> None:
        item = (room, name)
        if not self.leaves:
            self.leaves, self.largest = [[item]], [item]
            return
        at = min(bisect_left(self.largest, item), len(self.leaves) - 1)
        leaf = self.leaves[at]
        insort(leaf, item)
        if len(leaf) > LEAF:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.largest[at : at + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self.largest[at] = leaf[-1]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that still holds ``size``."""
        at = bisect_left(self.largest, (size, -1))
        if at == len(self.leaves):
            return None
        leaf = self.leaves[at]
        item = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.largest[at] = leaf[-1]
        else:
            del self.leaves[at], self.largest[at]
        return item


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """The bin of each item and each bin's fill; an item above the capacity gets a bin of its own.

    Ties go to the earlier item and the bin opened first.
    """
    tree, fill, place = CapacityTree(), [], np.empty(len(sizes), np.int64)
    for i in np.argsort(-np.asarray(sizes), kind="stable"):
        size = int(sizes[i])
        found = tree.take_tightest(size)
        if found is None:
            room, name = max(capacity, size), len(fill)
            fill.append(0)
        else:
            room, name = found
        fill[name] += size
        place[i] = name
        if room > size:
            tree.add(room - size, name)
    return place, fill


def pack_into(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The bin of each item for ``shards`` bins of the smallest capacity that best fit needs.

    Items above a fair share are bins of their own and leave the fair share of the others.
    """
    place = np.full(len(sizes), -1, np.int64)
    order = np.argsort(-np.asarray(sizes), kind="stable")
    own, rest = 0, int(np.sum(sizes))
    while own < min(shards - 1, len(order)) and sizes[order[own]] * (shards - own) > rest:
        rest -= int(sizes[order[own]])
        place[order[own]] = own
        own += 1
    left = order[own:]
    if not len(left):
        return place
    low = max(-(-rest // (shards - own)), int(sizes[left[0]]))
    high, best = low, None
    step = max(1, low // 100_000)
    while best is None:
        bins, fill = best_fit_decreasing(sizes[left], high)
        if len(fill) <= shards - own:
            best = bins
        else:
            low, high, step = high + 1, high + step, step * 2
    while low < high:
        middle = (low + high) // 2
        bins, fill = best_fit_decreasing(sizes[left], middle)
        if len(fill) <= shards - own:
            best, high = bins, middle
        else:
            low = middle + 1
    place[left] = own + best
    return place


def fixed_capacity_shards(groups: DataFrame, capacity: int, cells: int = CELLS) -> DataFrame:
    """(key, size) rows with ``cell`` and ``bin``: as few bins of ``capacity`` as best fit finds in each cell.

    Bins are named by cell and number. Every cell can leave part-filled bins, so use few cells for small
    inputs. ``key`` must be unique; sizes of 0 or more.
    """

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable")
        bins, _ = best_fit_decreasing(rows["size"].to_numpy(), capacity)
        return rows.assign(bin=bins)

    dealt = groups.select("key", F.col("size").cast("long").alias("size"), F.pmod(F.xxhash64("key"), F.lit(cells)).cast("int").alias("cell"))
    return dealt.groupBy("cell").applyInPandas(pack, "key binary, size long, cell int, bin long")


def shard_by_bytes(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's shard and gapless slot; rows with equal texts share a shard.

    Size: UTF-8 bytes plus 1; a null text counts as empty and is one group with empty texts. Null and
    repeated ids keep a row each. An empty table gives an empty result. Slots follow no order of meaning.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"),
    )
    rows = written(rows, "shard-rows")  # part and at hold from here on
    spark = docs.sparkSession
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    pallet = max(1, total // (shards * PALLETS_PER_SHARD))
    packed = written(fixed_capacity_shards(groups, pallet), "shard-pallets")
    # At most 2 * shards * PALLETS_PER_SHARD + CELLS pallets: two of a cell never fit into one.
    pallets = (
        packed.groupBy("cell", "bin").agg(F.sum("size").alias("size"), F.min("key").alias("first")).toPandas()
    )
    pallets = pallets.sort_values(["size", "first"], kind="stable", ignore_index=True)
    pallets["shard"] = pack_into(pallets["size"].to_numpy(), shards)
    where = spark.createDataFrame(
        [(int(c), int(b), int(s)) for c, b, s in pallets[["cell", "bin", "shard"]].itertuples(index=False)],
        "cell int, bin long, shard int",
    )
    homes = packed.join(F.broadcast(where), ["cell", "bin"]).select("key", "shard")
    placed = written(rows.join(homes, "key").drop("key"), "shard-placed")
    # Slots: rows before the same shard's part, plus the place inside it. No window holds a whole shard.
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.selectExpr(
        "shard", "part",
        "sum(n) OVER (PARTITION BY shard ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base",
    )
    return (
        placed.selectExpr("*", "row_number() OVER (PARTITION BY part, shard ORDER BY at) - 1 AS place")
        .join(before, ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
            (F.coalesce("base", F.lit(0)) + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
