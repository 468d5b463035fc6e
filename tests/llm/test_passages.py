"""Repeated passages of a few lines against brute force."""

import hashlib

import pytest

from ledgerlark.llm import passages, queries
from ledgerlark.llm.lines import NO_ID
from tests.llm.fixture import DOCS, by_row, corpus, prose


def brute(rows: list[tuple]) -> list[tuple]:
    """Every two neighbouring lines by dictionaries."""
    cut = [(NO_ID if i is None else i, [] if t is None else t.split("\n")) for i, t, *_ in rows]
    keeper = {}
    for owner, own in cut:
        for pair in zip(own, own[1:]):
            keeper[pair] = min(keeper.get(pair, owner), owner)
    out = []
    for (i, text, *_), (owner, own) in zip(rows, cut):
        pairs = list(zip(own, own[1:]))
        again = [n for n, p in enumerate(pairs) if keeper[p] != owner or n - pairs.index(p) >= 2]
        gone = {n for at in again for n in (at, at + 1)}
        kept = "\n".join(x for n, x in enumerate(own) if n not in gone)
        out.append((i, None if text is None else kept, len(own), len(gone)))
    return sorted(out, key=repr)


def test_passages(spark):
    rows = corpus() + [(70, "same\n" * 9, "en", "", None, 0, None), (71, "a\nb\na\nb\nc\na", "en", "", None, 0, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = passages.dedup_passages(docs).collect()
    assert by_row(got, ["doc_id", "text", "n_lines", "n_removed"]) == brute(rows)
    light = passages.dedup_passages(docs, digest_only=True).collect()
    want = [(r["doc_id"], None if r["text"] is None else hashlib.sha256(r["text"].encode()).hexdigest()) for r in got]
    assert by_row(light, ["doc_id", "kept_sha256"]) == sorted(want, key=repr)
    assert passages.dedup_passages(spark.createDataFrame([], DOCS)).collect() == []


def test_bytes_decide():
    """A mark removes its lines only where they are what it says; pairs in a marked chunk need none of their own."""
    raw, starts, ends = b"a\nb\ncc\nd", [0, 2, 4, 7], [1, 3, 6, 8]
    assert passages.without(raw, starts, ends, [{"at": 1, "content": b"b\ncc"}]) == (b"a\nd", 2)
    for other in (b"b\nc", b"b\ncx", b"a\nb", b"cc\nd\ne"):
        assert passages.without(raw, starts, ends, [{"at": 1, "content": other}]) == (raw, 0)


def test_only_pairs_outside_chunks_are_looked_at(spark):
    place = [(i, 2, bytes([i])) for i in range(9)] + [(2, 4, b"x")]
    rows = spark.createDataFrame([(1, 7, place)], "owner long, key long, places array<struct<at:int,lines:int,digest:binary>>")
    left = sorted((r["at"], r["lines"]) for r in passages.uncovered(rows).collect())
    assert left == [(0, 2), (1, 2), (2, 4), (5, 2), (6, 2), (7, 2), (8, 2)]


@pytest.mark.parametrize("length", range(2, 11))
def test_short_passages_in_other_surroundings_go(spark, tmp_path, length):
    """All of a passage is removed from each later document, and nothing else is."""
    rows = []
    for n in range(20):
        passage = [prose(10_000 + 100 * length + 20 * n + i, 6) for i in range(length)]
        for copy in range(2):
            around = [prose(50_000 + 1_000 * length + 40 * n + 20 * copy + i, 6) for i in range(8)]
            rows.append((2 * n + copy, "\n".join([*around[:4], *passage, *around[4:]]), "en", "", 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op5_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(i, length * (i % 2)) for i in range(40)]
