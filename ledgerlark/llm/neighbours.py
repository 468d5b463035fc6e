"""Approximate nearest neighbours by a permutation index.

Pivots lie far from each other; a vector is represented by its nearest pivots in their order. Rows are dealt
into blocks, and in a block every pivot has an inverted file of the entries that list it, with the place it
has there. A query visits the files of its own pivots and adds up, for every entry it meets, how well the
places agree; that is the footrule distance of the two orders. The entries nearest by footrule, a share that
falls as the table grows, are compared by inner product. Vectors of different length get one more
coordinate that makes them equally long, so the largest inner product is the smallest angle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import written

#: Pivots: about the square root of the different vectors, within these bounds, picked farthest first from
#: a sample of four times as many: the vectors with the smallest hash of their id.
PIVOTS_LEAST = 64
PIVOTS_MOST = 2_048
SAMPLED = 4
#: Pivots in a vector's list.
LISTED = 64
#: Entries compared with a query are this many times the square root of the different vectors.
RERANKED = 12
#: Entries and queries of one task's block.
BLOCK_ENTRIES = 20_000
BLOCK_QUERIES = 5_000


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector), one for each id, finite and not zero; of several for an id the smallest counts."""
    vector = F.col(vector_col).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def longer(vectors: np.ndarray, square: float) -> np.ndarray:
    """One more coordinate, with which every vector has the squared length ``square``."""
    rest = np.maximum(square - (vectors**2).sum(1), 0)
    return np.column_stack([vectors, np.sqrt(rest)])


def farthest_first(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of the sample, each the one with the smallest product with those before it."""
    chosen, near = [0], sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        at = int(np.argmin(near))
        chosen.append(at)
        near = np.maximum(near, sample @ sample[at])
    return sample[chosen]


def listed_pivots(vectors: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """For each vector its nearest pivots, nearest first."""
    far = -(vectors @ pivots.T)
    some = np.argpartition(far, count - 1, axis=1)[:, :count]
    order = np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1).astype(np.int32)


def with_pivots(classes: DataFrame, pivots: np.ndarray, square: float, query: bool) -> DataFrame:
    """(cid, vector, ids, pivots)."""
    count = min(LISTED, len(pivots))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            if len(rows):
                x = np.stack(rows["vector"]).astype(float)
                own = np.column_stack([x, np.zeros(len(x))]) if query else longer(x, square)
                yield pd.DataFrame(
                    {"cid": rows["cid"], "vector": rows["vector"], "ids": rows["ids"], "pivots": list(listed_pivots(own, pivots, count))}
                )

    return classes.mapInPandas(run, "cid long, vector array<double>, ids array<long>, pivots array<int>")


class InvertedFiles:
    """A block's entries by the pivots they list, with what their place there counts: more, the nearer."""

    def __init__(self, lists: np.ndarray, pivots: int) -> None:
        self.entries, self.listed = lists.shape
        order = np.argsort(lists.ravel(), kind="stable")
        self.entry, self.weight = order // self.listed, (self.listed - order % self.listed).astype(np.float64)
        self.cuts = np.searchsorted(lists.ravel()[order], np.arange(pivots + 1))

    def agreement(self, own: np.ndarray) -> np.ndarray:
        """For each entry the sum over common pivots of the smaller count of the two places.

        With k pivots listed and a place behind them for all others, the footrule distance of two lists is
        k (k + 1) less twice this.
        """
        parts = [slice(self.cuts[p], self.cuts[p + 1]) for p in own]
        most = np.repeat(np.arange(len(own), 0, -1.0), [s.stop - s.start for s in parts])
        weights = np.minimum(np.concatenate([self.weight[s] for s in parts]), most)
        return np.bincount(np.concatenate([self.entry[s] for s in parts]), weights, self.entries)


def search_block(count: int, pivots: int, share: float):
    """For cogrouped entries and queries of a block: the best ``count`` classes found for each query."""

    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = {"query": [], "cid": [], "score": [], "ids": []}
        if len(entries) and len(queries):
            entries = entries.sort_values("cid", kind="stable")
            x, cid, ids = np.stack(entries["vector"]), entries["cid"].to_numpy(), entries["ids"].to_numpy()
            files = InvertedFiles(np.stack(entries["pivots"]), pivots)
            most = min(len(x), math.ceil(share * len(x)) + 2 * count)
            for name, own, listed in zip(queries["cid"], queries["vector"], queries["pivots"]):
                agreement = files.agreement(listed)
                near = np.argpartition(-agreement, most - 1)[:most] if most < len(x) else np.arange(len(x))
                score = (x[near] * own).sum(1)  # the same sum for a pair everywhere, so that ties are ties
                order = np.lexsort((cid[near], -score))[:count]
                best = near[order]
                found["query"] += [name] * len(best)
                found["cid"] += cid[best].tolist()
                found["score"] += score[order].tolist()
                found["ids"] += ids[best].tolist()
        return pd.DataFrame(found)

    return run


def compared_share(different: int) -> float:
    """The share of the different vectors that a query is compared with by inner product."""
    return min(1.0, RERANKED / math.sqrt(max(1, different)))


def nearest(
    rows: DataFrame, every: int, count: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``count`` nearest found, by inner product, for each vector whose id is divisible by ``every``.

    Columns query_id, rank (from 1), vec_id, score; ties go to the smaller id. Every other id is a
    candidate; equal vectors are searched for once and then stand for all their ids. Null, zero, and not
    finite vectors and rows without an id take no part; of several vectors for one id the smallest does.
    Vectors of different lengths raise an error. Entries are taken as doubles. An empty table gives an
    empty result.
    """
    vectors = written(valid_vectors(rows, id_col, vector_col), "ann-vectors")
    sizes = vectors.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} entries")
    wanted = count + 1  # one may be the query itself
    # The limit on the row number is applied before the shuffle too, so a hot vector sends few rows.
    numbered = vectors.selectExpr("*", "row_number() OVER (PARTITION BY vector ORDER BY vec_id) AS n")
    classes = (
        numbered.where(F.col("n") <= wanted)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("cid", F.get("ids", F.lit(0)))
    )
    classes = written(classes, "ann-classes")
    askers = vectors.where(F.col("vec_id") % every == 0)
    askers = written(askers.join(classes.select("vector", "cid"), "vector").select("vec_id", "cid"), "ann-queries")
    asked = classes.join(askers.select("cid").distinct(), "cid", "left_semi")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    different, square = classes.agg(F.count("*"), F.max(squares)).first()
    wished = min(PIVOTS_MOST, max(PIVOTS_LEAST, math.isqrt(different)))
    # At most 8,192 rows.
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLED * wished).select("vector").collect()
    pivots = farthest_first(longer(np.array([r["vector"] for r in sample], float), square), wished) if sample else np.zeros((1, 1))
    entries = written(with_pivots(classes, pivots, square, False), "ann-entries")
    queries = written(with_pivots(asked, pivots, square, True), "ann-asked")
    n_queries = queries.count()
    blocks = {"entry_block": -(-different // BLOCK_ENTRIES) or 1, "query_block": -(-n_queries // BLOCK_QUERIES) or 1}

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        """Every row in one of its own blocks, met with each of the other side's."""
        every_one = F.explode(F.sequence(F.lit(0), F.lit(blocks[other] - 1)))
        return frame.withColumns({own: F.pmod(F.xxhash64("cid"), F.lit(blocks[own])).cast("int"), other: every_one})

    key = ["entry_block", "query_block"]
    found = (
        dealt(entries, "entry_block", "query_block").groupBy(*key)
        .cogroup(dealt(queries, "query_block", "entry_block").groupBy(*key))
        .applyInPandas(search_block(wanted, len(pivots), compared_share(different)), "query long, cid long, score double, ids array<long>")
    )
    own = asked.select(F.col("cid").alias("query"), "cid", squares.alias("score"), "ids")
    ranked = (
        found.unionByName(own)
        .groupBy("query", "cid")
        .agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
        .select("query", "score", F.explode("ids").alias("vec_id"))
        .selectExpr("*", "row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS n")
        .where(F.col("n") <= wanted)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    )
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, count)
    return (
        askers.select(F.col("vec_id").alias("query_id"), F.col("cid").alias("query"))
        .join(ranked, "query")
        .select("query_id", F.posexplode(others).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
