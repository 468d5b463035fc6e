"""Documents linked by the Jaccard similarity of their word n-gram sets: a prefix-tree join.

Sets are ordered by their n-grams' hashes, one order for the whole corpus. Pairs of neighbours in that order
bring candidates together: very similar sets have most of them in common, while sets that only share n-grams
here and there, as all texts of a large corpus do, have hardly any. For lower thresholds, at which even linked
sets have few pairs in common, single n-grams do. Inside a group of candidates the sets
are stored in a prefix tree, every set walks it once, shared beginnings are counted once, and a subtree is
left as soon as the n-grams that remain cannot reach the threshold. Equal sets are one class throughout.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import (
    FOLDED_VALUES,
    blocks,
    sequence_hashes,
    text_key,
    word_hashes,
    word_spans,
)
from ledgerlark.llm.links import components
from ledgerlark.session import written

#: One in so many n-grams of a set is added to its prefix, so that the commonest can be left out.
SPARE = 6
#: Pairs are what candidates meet by if linked sets share so many hundredths of them.
PAIRED = 75
#: Sets of one block of a large candidate group; up to four times as many if they have no more n-grams than this.
BLOCK_SETS = 256
BLOCK_GRAMS = 1 << 18
RUN = 16


def gram_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted n-gram hashes of each text, A-Z as a-z; fewer than k words: the whole sequence as one."""
    starts, ends, before = word_spans(data, offsets)
    words = word_hashes(data, starts, ends, FOLDED_VALUES)
    grams = sequence_hashes(words, k)
    for a, b in zip(before.tolist(), before[1:].tolist()):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            yield sequence_hashes(words[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def pair_percent(percent: int) -> int:
    """Hundredths of a set's pairs of neighbours that any linked, different set has at least.

    Sets that share o n-grams and differ by d have o - 1 - d pairs in common or more, as an n-gram that is not
    shared parts one pair at most. Either has at most o + d - 1 pairs, and d * percent <= o * (100 - percent):
    the share is least for d = 1.
    """
    return (300 * percent - 20_000) // percent


def paired(percent: int) -> bool:
    return pair_percent(percent) >= PAIRED


def keys_of(s: np.ndarray, percent: int) -> np.ndarray:
    """What candidates meet by, ordered: hashes of an ordered set's pairs of neighbours, or its n-grams."""
    return np.unique(sequence_hashes(s, 2)) if paired(percent) else s


def shared_percent(percent: int) -> int:
    """Hundredths of a set's keys that any linked, different set has at least."""
    return pair_percent(percent) if paired(percent) else percent


def spare(size: int) -> int:
    """N-grams of the prefix beyond the usual one, of which a set may leave out as many, less one."""
    return 1 + size // SPARE


def prefix_of(s: np.ndarray, percent: int) -> np.ndarray:
    """The beginning of an ordered set that shares ``spare`` n-grams with any linked set's beginning.

    ``spare`` is that of the smaller of the two.
    """
    return s[: len(s) - -(-percent * len(s) // 100) + spare(len(s))]


def left_out(size: int, percent: int) -> int:
    """How many of its commonest prefix n-grams a set can do without: one fewer than any linked set shares."""
    return spare(-(-percent * size // 100)) - 1


def class_of(s: np.ndarray) -> int | None:
    """A 64-bit name of a set; two of n different sets share one with probability n * n / 2 ** 65."""
    return int.from_bytes(hashlib.sha256(s.tobytes()).digest()[:8], "little", signed=True) if len(s) else None


def class_rows(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, key, n_shingles, cid) of (doc_id, key, text) rows; cid is null for an empty set."""
    kinds = [("doc_id", pa.int64()), ("key", pa.binary()), ("n_shingles", pa.int64()), ("cid", pa.int64())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column(2)):
                found = [(len(s), class_of(s)) for s in gram_sets(data, offsets, k)]
                sizes, names = zip(*found)
                columns = [batch.column(0).slice(row, len(sizes)).cast(pa.int64()), batch.column(1).slice(row, len(sizes)).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(names, pa.int64())], schema=schema)

    return texts.mapInArrow(run, "doc_id long, key binary, n_shingles long, cid long")


def prefix_rows(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(cid, gram) of (text) rows: the prefix of each set's keys, once for every copy."""
    schema = pa.schema([("cid", pa.int64()), ("gram", pa.int64())])
    shared = shared_percent(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in blocks(batch.column(0)):
                sets = [s for s in gram_sets(data, offsets, k) if len(s)]
                if not sets:
                    continue
                prefixes = [prefix_of(keys_of(s, percent), shared) for s in sets]
                names = np.repeat(np.array([class_of(s) for s in sets], np.int64), [len(x) for x in prefixes])
                grams = np.concatenate(prefixes).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(grams)], schema=schema)

    return texts.mapInArrow(run, "cid long, gram long")


def candidate_groups(texts: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, component): classes that can be linked, directly or through others, share a component.

    The keys of a set's prefix are ranked by how common they are; so many of the commonest are left out that
    a linked set still shares one of the others. Frequent lines and passages fall away by that.
    """
    prefixes = prefix_rows(texts, k, percent)
    common = prefixes.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    common = written(common, "jaccard-common")
    shared = shared_percent(percent)
    keys = F.first("n_shingles") - int(paired(percent))
    sizes = rows.where("cid IS NOT NULL").groupBy("cid").agg(keys.alias("size"))
    skipped = F.floor(F.ceil(F.col("size") * shared / 100) / SPARE).cast("int")
    kept = (
        prefixes.join(common, "gram")
        .groupBy("cid")
        .agg(F.sort_array(F.collect_set(F.struct("n", "gram")), asc=False).alias("grams"))
        .join(sizes, "cid")
        .where(F.size("grams") > skipped)
        .select("cid", F.explode(F.slice("grams", skipped + 1, F.size("grams"))).alias("g"))
        .select("cid", F.col("g.gram").alias("gram"))
    )
    kept = written(kept, "jaccard-kept")
    first = written(kept.groupBy("gram").agg(F.min("cid").alias("first")), "jaccard-first")
    stars = kept.join(first, "gram").where("cid <> first").select(F.col("cid").alias("a"), F.col("first").alias("b"))
    return components(stars, "jaccard-candidates")


def set_rows(texts: DataFrame, k: int) -> DataFrame:
    """(component, cid, grams) of (component, cid, text) rows: the sorted n-gram hashes as bytes."""
    schema = pa.schema([("component", pa.int64()), ("cid", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column(2)):
                sets = [s.tobytes() for s in gram_sets(data, offsets, k)]
                columns = [batch.column(i).slice(row, len(sets)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], schema=schema)

    return texts.mapInArrow(run, "component long, cid long, grams binary")


class Node:
    """A piece of ordered n-grams that all sets below it continue with."""

    __slots__ = ("ends", "grams", "largest", "nexts", "smallest")

    def __init__(self, grams: list[int], size: int) -> None:
        self.grams, self.nexts, self.ends = grams, {}, []
        self.smallest = self.largest = size

    def cut(self, at: int) -> None:
        """Move what follows the first ``at`` n-grams into a node below."""
        lower = Node(self.grams[at:], 0)
        lower.nexts, lower.ends = self.nexts, self.ends
        lower.smallest, lower.largest = self.smallest, self.largest
        self.grams, self.nexts, self.ends = self.grams[:at], {lower.grams[0]: lower}, []


def insert(root: Node, grams: list[int], name: int) -> None:
    node, at, size = root, 0, len(grams)
    while True:
        node.smallest, node.largest = min(node.smallest, size), max(node.largest, size)
        if at == size:
            node.ends.append((name, size))
            return
        below = node.nexts.get(grams[at])
        if below is None:
            node.nexts[grams[at]] = leaf = Node(grams[at:], size)
            leaf.ends.append((name, size))
            return
        same, most = 1, min(len(below.grams), size - at)
        while same < most and below.grams[same] == grams[at + same]:
            same += 1
        if same < len(below.grams):
            below.cut(same)
        node, at = below, at + same


def partners(root: Node, grams: list[int], percent: int) -> Iterator[int]:
    """Names of the stored sets that are linked with this one."""
    own, size = set(grams), len(grams)
    stack = [(node, 0, 0) for node in root.nexts.values()]
    while stack:
        node, depth, shared = stack.pop()
        if node.smallest * percent > 100 * size or node.largest * 100 < percent * size:
            continue
        # The least overlap that any set below needs; it grows with the set.
        need = -(-percent * (size + max(node.smallest, -(-percent * size // 100))) // (100 + percent))
        for i in range(0, len(node.grams), RUN):
            piece = node.grams[i : i + RUN]
            shared += len(own.intersection(piece))
            depth += len(piece)
            left = size - bisect_right(grams, piece[-1])
            if shared + min(left, node.largest - depth) < need:
                break
        else:
            for name, n in node.ends:
                if shared * (100 + percent) >= percent * (size + n):
                    yield name
            stack += [(below, depth, shared) for below in node.nexts.values()]


def join_block(percent: int):
    """For applyInPandas: links of a block pair as a forest, at most one edge fewer than sets."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("cid")
        parent = {c: c for c in rows["cid"].tolist()}

        def top(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        edges, root = [], Node([], 0)
        root.smallest, root.largest = 1 << 60, 0
        items = [(len(g) // 8, c, np.frombuffer(g, "<u8").tolist(), b) for c, g, b in zip(rows["cid"].tolist(), rows["grams"], rows["block"].tolist())]
        items.sort(key=lambda x: x[:2])
        one = rows["first"].iloc[0] == rows["second"].iloc[0]
        low = int(rows["first"].iloc[0])
        if not one:
            for _, c, grams, block in items:
                if block == low:
                    insert(root, grams, c)
        for _, c, grams, block in items:
            if not one and block == low:
                continue
            for other in partners(root, grams, percent):
                a, b = top(c), top(other)
                if a != b:
                    parent[a] = b
                    edges.append((c, other))
            if one:
                insert(root, grams, c)
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return run


def linked_documents(
    docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, key, n_shingles, component_id) for every row; key is the SHA-256 of the text.

    Two documents are linked when their sets' intersection has at least ``percent`` hundredths of their
    union; a component is named by its smallest id. A null, empty or wordless text is linked with
    nothing. Repeated rows belong together; a null id has no name of its own.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = written(class_rows(texts, k), "jaccard-classes")
    groups = candidate_groups(texts.select("text"), rows, k, percent)
    chosen = rows.where("cid IS NOT NULL").groupBy("cid").agg(F.min("key").alias("key"), F.first("n_shingles").alias("size"))
    wanted = chosen.join(groups.withColumnsRenamed({"id": "cid"}), "cid")
    # Copies of a text are combined before the shuffle.
    different = texts.groupBy("key").agg(F.first("text").alias("text"))
    sets = set_rows(different.join(wanted, "key").select("component", "cid", "text"), k)
    # Written, like the names below: a join with a shuffle of its own on either side can be split.
    most = F.ceil(F.count("*") / BLOCK_SETS)
    least = F.greatest(F.ceil(F.count("*") / (4 * BLOCK_SETS)), F.ceil(F.sum("size") / BLOCK_GRAMS))
    sizes = wanted.groupBy("component").agg(F.least(most, least).cast("int").alias("blocks"))
    sizes = written(sizes, "jaccard-sizes")
    dealt = (
        sets.join(sizes, "component")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", "cid", "grams", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    )
    links = dealt.groupBy("component", "first", "second").applyInPandas(join_block(percent), "a long, b long")
    joined = components(links, "jaccard-links")
    rows = rows.join(joined.withColumnsRenamed({"id": "cid"}), "cid", "left").withColumn("label", F.coalesce("component", "cid"))
    names = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = written(names, "jaccard-names")
    return rows.join(names, "label", "left").select(
        "doc_id", "key", "n_shingles",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the document with the smallest id stays.

    Rows that share its id and text are that document. Rows without words all stay, and so does one
    document of a component in which no row has an id.
    """
    linked = linked_documents(docs, k, percent, id_col, text_col)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    # A component without any id is named by its text's key here.
    name = F.coalesce(F.col("component_id").cast("string"), F.hex("key"))
    staying = (
        linked.where("n_shingles > 0").groupBy(name.alias("name")).agg(least.alias("stays"))
        .select("stays.doc_id", "stays.key")
        .unionByName(linked.where("n_shingles = 0").select("doc_id", "key").distinct())
    )
    staying = staying.withColumnsRenamed({"doc_id": "__id", "key": "__key"})
    keyed = docs.withColumn("__text_key", text_key(text_col))
    same = keyed[id_col].cast("long").eqNullSafe(staying["__id"]) & (keyed["__text_key"] == staying["__key"])
    return keyed.join(staying, same, "left_semi").drop("__text_key")
