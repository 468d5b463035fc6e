"""The prefix trie against brute force over dictionaries."""

import hashlib
import zlib

import pytest

from ledgerlark.llm import tries

KIND = "conv_id long, turn long, role string, text string, depth string, path string"


def brute(rows: list[tuple]) -> list[tuple]:
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, mark), (role, text)))
    turns = {c: [t for _, t in sorted(r, key=lambda x: x[0])] for c, r in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    members = {}
    for c, r in rebuilt.items():
        for d in range(len(r) + 1):
            members.setdefault(tuple(r[:d]), []).append(c)
    out = []
    for path, convs in members.items():
        children = [p for p in members if len(p) == len(path) + 1 and p[:-1] == path]
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **sizes):
    docs = spark.createDataFrame(rows, KIND).repartition(3)
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    got = tries.conversation_trie(docs, **sizes)
    assert got.columns == columns
    return sorted((tuple(r) for r in got.collect()), key=repr)


def awkward() -> list[tuple]:
    rows = []
    for c in (*range(23), 31, 32, 33, 1_000_003):
        for t in range(c % 7):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"é{t}" if t < 3 else f"{c % 3}-{t}", "x", "y"))
    rows += [
        (None, 1, "user", "lost", "", ""), (40, None, None, None, "", ""), (40, 1, "", "", "", ""), (41, 1, "", "", "", ""),
        (42, 5, "user", "same", "", ""), (42, 5, "user", "same", "", ""), (42, 5, "user", "other", "", ""),
        (44, 0, "user", "x" * 100_000, "", ""),
    ]
    return rows


def test_awkward_rows(spark):
    assert found(spark, awkward()) == brute(awkward())
    assert found(spark, []) == []


@pytest.mark.parametrize("shard, block", [(3, 2), (2, 64), (1000, 5)])
def test_small_shards_and_blocks(spark, shard, block):
    """Long conversations over many blocks and parts, shards of a few conversations, copies of all of it."""
    rows = awkward()
    for c in (50, 55, 56, 57, 60):
        rows += [(c, t, "user", f"long {t}" if t < 40 or c == 50 else f"{c} {t}", "", "") for t in range(50)]
    rows += [(c, t, "user", "copy", "", "") for c in range(70, 90) for t in range(3)]
    assert found(spark, rows, block_turns=block, shard_conversations=shard) == brute(rows)
