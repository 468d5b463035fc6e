"""The prefix trie of a table of conversations, from vertical bitmaps.

Conversations are cut into blocks of 64 turns. A shard is a run of neighbouring conversations in one block;
for each position and turn it has a bitset of the conversations that have the turn there. A depth-first walk
intersects a parent's bitset with these postings: every intersection that is not empty is a child, its bits
are the members. Nodes of different shards are one node if their paths are equal; a path is known by a
SHA-256 over the digests of its turns, so shards are merged by grouping.

Sums over subtrees need no walk over the merged trie. The smallest member of a node owns it; a conversation
owns the lower end of its path, so each node's subtree is what its members own from there on. That makes
every such sum one over members, which the bitmaps give.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import written

BLOCK_TURNS = 64
SHARD_CONVERSATIONS = 1_024
#: The path of the root. The path of a node is the SHA-256 of its block's first path and of the SHA-256 of
#: the turn digests in the block so far.
ROOT_PATH = bytes(32)

NODES = pa.schema(
    [
        ("path", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("least", pa.int64()), ("n", pa.int64()),
        ("size", pa.int64()), ("before", pa.int64()), ("unowned", pa.int64()), ("leaves", pa.int64()), ("ends", pa.string()),
    ]
)
NODE_TYPES = (
    "path binary, parent binary, depth long, least long, n long, size long, before long, "
    "unowned long, leaves long, ends string"
)


def as_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ordered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, digest, size, part, at): turns in order, dealt by ranges so that a conversation may span parts."""
    own, said = as_text(role), as_text(text)
    digest = F.sha2(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own, said), 256)
    turns = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.unhex(digest).alias("digest"),
        F.octet_length(said).cast("long").alias("size"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "digest", "size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    )


def rebuilt_turns(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, digest, size, length) of every rebuilt turn, and (conv, base, h, k, length) of conversations.

    Only numbers of conversations and parts are joined to the turns; a head row goes to its few neighbours.
    """
    parts = ordered.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    parts = written(
        parts.selectExpr(
            "conv", "part", "first",
            "coalesce(sum(n) OVER (PARTITION BY conv ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier",
            "sum(n) OVER (PARTITION BY conv) AS total",
        ),
        "trie-parts",
    )
    totals = parts.select("conv", "total").distinct()
    convs = totals.withColumn("base", F.expr("conv - conv % 5")).withColumn(
        "h", F.when(F.col("conv") == F.col("base"), F.lit(0)).otherwise(F.expr("crc32(CAST(CAST(conv AS STRING) AS BINARY)) % 9"))
    )
    bases = totals.select(F.col("conv").alias("base"), F.col("total").alias("base_total"))
    convs = convs.join(bases, "base", "left").selectExpr(
        "conv", "base", "h", "least(h, coalesce(base_total, 0)) AS k",
        "least(h, coalesce(base_total, 0)) + greatest(total - h, 0) AS length",
    )
    convs = written(convs, "trie-conversations")
    takers = convs.where("k > 0").groupBy(F.col("base").alias("conv")).agg(F.collect_list(F.struct("conv", "k", "length")).alias("takers"))
    places = parts.join(convs.drop("base"), "conv").join(takers, "conv", "left")
    targets = F.expr(
        "concat(CASE WHEN p > h THEN array(named_struct('conv', conv, 'pos', p - h + k, 'length', length)) "
        "ELSE array() END, transform(filter(coalesce(takers, array()), t -> p <= t.k), "
        "t -> named_struct('conv', t.conv, 'pos', p, 'length', t.length)))"
    )
    turns = (
        ordered.join(places, ["conv", "part"])
        .withColumn("p", F.expr("at - first + earlier + 1"))
        .select("digest", "size", F.explode(targets).alias("to"))
        .select("to.conv", "to.pos", "digest", "size", "to.length")
    )
    return turns, convs


def turn_blocks(turns: DataFrame, convs: DataFrame, block_turns: int) -> DataFrame:
    """(conv, block, length, digests, sizes): up to ``block_turns`` turns in a row; a conversation without turns has an empty one."""
    block = F.expr(f"(pos - 1) DIV {block_turns}")
    cut = (
        turns.groupBy("conv", block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "size"))).alias("turns"), F.first("length").alias("length"))
        .select("conv", "block", "length", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))
    )
    empty = convs.where("length = 0").selectExpr(
        "conv", "0L AS block", "length", "CAST(array() AS array<binary>) AS digests", "CAST(array() AS array<bigint>) AS sizes"
    )
    return cut.unionByName(empty)


def with_starts(blocks: DataFrame, block_turns: int) -> DataFrame:
    """Blocks with ``start``, the path before them, and ``before``, the bytes before them.

    The paths of a conversation's blocks follow from each other: one digest for every full block of the
    conversations with more than one, streamed in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, path, before = None, ROOT_PATH, 0
        for batch in batches:
            paths, bytes_before = [], []
            for c, digest, size in zip(*(x.to_pylist() for x in batch.columns[0:1] + batch.columns[2:4])):
                if c != conv:
                    conv, path, before = c, ROOT_PATH, 0
                path, before = hashlib.sha256(path + digest).digest(), before + size
                paths.append(path)
                bytes_before.append(before)
            following = [b + 1 for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(following, pa.int64()), pa.array(paths, pa.binary()), pa.array(bytes_before, pa.int64())],
                names=["conv", "block", "start", "before"],
            )

    digest = F.unhex(F.sha2(F.unhex(F.array_join(F.transform("digests", F.hex), "")), 256))
    full = blocks.where(f"length > {block_turns} * (block + 1)").select("conv", "block", digest.alias("digest"), total_size().alias("size"))
    starts = full.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(run, "conv long, block long, start binary, before long")
    first = blocks.where("block = 0").withColumns({"start": F.lit(ROOT_PATH), "before": F.lit(0).cast("long")})
    return first.unionByName(blocks.where("block > 0").join(starts, ["conv", "block"]).select(*first.columns))


def total_size() -> Column:
    return F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)


def bits(members: int) -> Iterator[int]:
    """The places of the set bits, rising."""
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def shard_nodes(first_depth: int, rows: list[tuple], collect) -> None:
    """Walk one shard, whose block starts below ``first_depth``: (conv, start, before, digests, sizes, length, unowned, leaf) rows, by rising conv.

    ``collect`` gets a row of NODES for each node that the shard has in this block.
    """
    deepest = max(len(r[3]) for r in rows)
    postings: list[dict[bytes, int]] = [{} for _ in range(deepest)]
    reach, ending, starts = [0] * (deepest + 1), [0] * (deepest + 1), {}
    for i, (_, start, _, digests, _, length, _, _) in enumerate(rows):
        bit = 1 << i
        starts[start] = starts.get(start, 0) | bit
        for at, digest in enumerate(digests):
            postings[at][digest] = postings[at].get(digest, 0) | bit
            reach[at] |= bit
        if first_depth + len(digests) == length:
            ending[len(digests)] |= bit

    def node(path: bytes, parent: bytes | None, at: int, members: int, size: int, before: int) -> None:
        own = [rows[i] for i in bits(members)]
        ends = ",".join(str(rows[i][0]) for i in bits(members & ending[at])) or None
        depth = first_depth + at
        collect((path, parent, depth, own[0][0], len(own), size, before, sum(r[6] for r in own), sum(r[7] for r in own), ends))

    for start, together in starts.items():
        before = rows[next(bits(together))][2]
        if first_depth == 0:
            node(start, None, 0, together, 0, 0)
        walk = [(start, hashlib.sha256(), 0, together, before)]
        while walk:
            parent, so_far, at, members, before = walk.pop()
            left = members & reach[at] if at < deepest else 0
            while left:
                first = rows[(left & -left).bit_length() - 1]
                digest, size = first[3][at], first[4][at]
                child = left & postings[at][digest]
                left ^= child
                longer = so_far.copy()
                longer.update(digest)
                path = hashlib.sha256(start + longer.digest()).digest()
                node(path, parent, at + 1, child, size, before)
                walk.append((path, longer, at + 1, child, before + size))


def trie_nodes(blocks: DataFrame, block_turns: int, shard_conversations: int) -> DataFrame:
    """NODES rows of every shard of (conv, block, length, digests, sizes, start, before, unowned, leaf) rows.

    Rows are dealt by ranges of block and conversation: whatever conversation is long or copied, a task has
    its share of them, and holds one shard at a time.
    """
    names = ["conv", "start", "before", "digests", "sizes", "length", "unowned", "leaf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, found = [], None, []

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), NODES)], schema=NODES)
            found.clear()
            return made

        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(["block", *names])}
            for own, row in zip(columns["block"], zip(*(columns[n] for n in names))):
                if shard and (own != block or len(shard) == shard_conversations):
                    shard_nodes(block * block_turns, shard, found.append)
                    shard = []
                    if len(found) > 10_000:
                        yield batch_of()
                block = own
                shard.append(row)
        if shard:
            shard_nodes(block * block_turns, shard, found.append)
        if found:
            yield batch_of()

    dealt = blocks.select("block", *names).repartitionByRange("block", "conv").sortWithinPartitions("block", "conv")
    return dealt.mapInArrow(run, NODE_TYPES)


def end_hashes(parts: DataFrame) -> DataFrame:
    """(path, ends_sha256) of (path, least, ends): the shards' lists in order, streamed into one hash."""
    schema = pa.schema([("path", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, digest = None, None
        for batch in batches:
            done = []
            for own, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own == path:
                    digest.update(b"," + ends.encode())
                    continue
                if path is not None:
                    done.append((path, digest.hexdigest()))
                path, digest = own, hashlib.sha256(ends.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], schema=schema)
        if path is not None:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()])], schema=schema)

    # The least end of a shard's list: lists of different shards do not overlap.
    first = F.substring_index("ends", ",", 1).cast("long")
    lists = parts.where("ends IS NOT NULL").select("path", first.alias("first"), "ends")
    return lists.repartition("path").sortWithinPartitions("path", "first").mapInArrow(run, "path binary, ends_sha256 string")


def conversation_trie(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block_turns: int = BLOCK_TURNS, shard_conversations: int = SHARD_CONVERSATIONS,
) -> DataFrame:
    """Every node of the trie of rebuilt conversations, the root included.

    Turns are ordered by ``turn``, null first, equal ones by the SHA-256 of role and text; null roles and
    texts count as empty. Rows without a conversation id are left out. A conversation takes its first h
    turns from the one whose id is its own less the remainder by 5 (h: CRC-32 of the id modulo 9), then its
    own after the first h; one that is left without turns is a member of the root only. Repeated rows are
    turns of their own. An empty table has no nodes. Returns conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    ordered = written(ordered_turns(rows, conv, turn, role, text), "trie-turns")
    turns, convs = rebuilt_turns(ordered)
    blocks = written(turn_blocks(turns, convs, block_turns), "trie-blocks")
    blocks = written(with_starts(blocks, block_turns), "trie-started")
    nothing = {"unowned": F.lit(0).cast("long"), "leaf": F.lit(0).cast("long")}
    parts = written(trie_nodes(blocks.withColumns(nothing), block_turns, shard_conversations), "trie-shards")
    nodes = parts.groupBy("path").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("least").alias("conv"),
        F.sum("n").alias("n"), F.min("before").alias("before"),
    )
    nodes = written(nodes, "trie-merged")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, "path", "left").na.fill(0, ["n_children"]), "trie-nodes")
    # What a conversation owns starts at one depth and goes to its end; what it does not own it saves.
    owners = nodes.groupBy("conv").agg(
        F.min("depth").alias("owned"), F.min("before").alias("unowned"), F.max(F.expr("CAST(n_children = 0 AS LONG)")).alias("leaf")
    )
    owners = written(owners, "trie-owners")
    totals = blocks.groupBy("conv").agg(F.sum(total_size()).alias("total"))
    weights = totals.join(owners, "conv", "left").selectExpr(
        "conv", "owned", "coalesce(unowned, total) AS unowned", "CASE WHEN owned IS NULL THEN 0 ELSE leaf END AS leaf"
    )
    shared = blocks.join(weights, "conv").withColumn("most", F.coalesce(F.col("owned") - 1, "length") - F.col("block") * block_turns)
    shared = shared.where("most > 0 OR most = 0 AND block = 0")
    cut = {c: F.slice(c, F.lit(1), F.col("most").cast("int")) for c in ("digests", "sizes")}
    others = trie_nodes(shared.withColumns(cut), block_turns, shard_conversations)
    others = others.groupBy("path").agg(F.sum("unowned").alias("unowned"), F.sum("leaves").alias("leaves"))
    parents = nodes.select(F.col("path").alias("parent"), F.col("conv").alias("parent_conv_id"))
    full = (
        nodes.join(written(others, "trie-others"), "path", "left")
        .join(written(end_hashes(parts), "trie-ends"), "path", "left")
        .join(owners.select("conv", "leaf"), "conv")
        .join(parents, "parent", "left")
    )
    return full.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
        (F.coalesce("unowned", F.lit(0)) - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
