"""Sharding, packing, BPE, line and substring dedup against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlark.llm import bpe, lines, packing, sharding, substrings
from tests.llm.fixture import DOCS, by_row, corpus, words_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_shards(docs):
    rows = sharding.shard_by_bytes(docs, 4).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in corpus()]
    assert by_row(rows, ["doc_id", "size", "text_crc32"]) == sorted(want, key=repr)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    homes = {}
    for r in rows:
        homes.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_best_fit_takes_the_tightest_bin():
    draw = random.Random(5)
    for _ in range(30):
        sizes = np.array([draw.randint(0, 60) for _ in range(400)])
        place, fill = sharding.best_fit_decreasing(sizes, 100)
        rooms, want = [], np.empty(400, int)
        for i in np.argsort(-sizes, kind="stable"):
            fits = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i] and room > 0]
            if not fits:
                rooms.append(100)
            b = min(fits)[1] if fits else len(rooms) - 1
            rooms[b] -= sizes[i]
            want[i] = b
        assert [100 - r for r in rooms] == fill
        assert (place == want).all()


def test_shards_are_near_equal_beside_a_hot_group():
    sizes = np.array([9_000] + [random.Random(i).randint(1, 60) for i in range(900)])
    place = sharding.pack_into(sizes, 8)
    fill = np.bincount(place, sizes, 8)
    others = np.delete(fill, place[0])
    assert fill[place[0]] == 9_000 and others.max() - others.min() <= 60


def test_fixed_capacity(spark):
    groups = spark.createDataFrame([(bytes([i]), 10 + i % 7) for i in range(90)], "key binary, size long")
    rows = sharding.fixed_capacity_shards(groups, 50, cells=2).collect()
    fill = Counter()
    for r in rows:
        fill[r["cell"], r["bin"]] += r["size"]
    assert len(rows) == 90 and max(fill.values()) <= 50


def test_packing(docs):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack_documents(docs, VOCABULARY, with_ids=True).collect()
    want = []
    for i, text, *_ in corpus():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((i, n, at, len(part), zlib.crc32(part.tobytes()), part.tobytes()))
    got = [(*x[:5], bytes(x[5])) for x in by_row(rows, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(w[3] for w in want) // 2048) + 1


@pytest.mark.parametrize("text", ["a <|startoftext|> b", "a<|startoftext|>b", "<|STARTOFTEXT|> x", "x<|endoftext|>", " <|startoftext|>  <|endoftext|>y", "é<|endoftext|><|endoftext|>ü"])
def test_strings_of_added_tokens_are_tokens(text):
    want = Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.token_ids(text, packing.chunk_ids(VOCABULARY)), "<u4").tolist() == want


def test_genetic_packing_keeps_every_item():
    draw = random.Random(3)
    sizes = [draw.randint(1, 700) for _ in range(300)]
    best = packing.evolve(packing.founders(sizes, 1000, draw, 4), sizes, 1000, draw, 5)
    for bins in best:
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert max(sum(sizes[i] for i in b) for b in bins) <= 1000
    assert len(best[0]) <= len(packing.founders(sizes, 1000, draw, 1)[0])


def test_round_trip(docs):
    coder = bpe.loaded(RANKS, public_tokenizers.PATTERN)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(coder.tokens)}, special_tokens={})
    want = []
    for i, text, *_ in corpus():
        ids = encoding.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    rows = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert by_row(rows, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == sorted(want, key=repr)
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in decoded) == sorted((t or "").encode() for _, t, *_ in corpus())


@given(st.text(alphabet=st.sampled_from(list("ab' \n\t é1!日\x1c")), max_size=30))
@settings(max_examples=300, deadline=None)
def test_texts_are_cut_where_no_match_reaches(text):
    coder = bpe.loaded(RANKS, public_tokenizers.PATTERN)
    assert coder.encode(text) == coder.encode_plain(text)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = np.frombuffer(packing.token_ids(text, packing.chunk_ids(VOCABULARY)), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def repeated(rows: list[tuple], window: int) -> list[tuple]:
    seen = Counter()
    for _, text, *_ in rows:
        words = words_of(text)
        seen.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = []
    for i, text, *_ in rows:
        words = words_of(text)
        gone = set()
        for at in range(len(words) - window + 1):
            if seen[tuple(words[at : at + window])] > 1:
                gone |= set(range(at, at + window))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy", [substrings.HEAVY_STRINGS, 1])
def test_substrings(docs, monkeypatch, heavy):
    monkeypatch.setattr(substrings, "HEAVY_STRINGS", heavy)
    rows = substrings.dedup_substrings(docs, digest_only=True).collect()
    assert by_row(rows, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == repeated(corpus(), 35)


def test_substrings_keep_columns_and_clean_texts(docs):
    out = substrings.dedup_substrings(docs)
    assert out.columns == [*docs.columns, "n_words", "n_removed"]
    before = {(r["key"]): r["text"] for r in docs.collect()}
    for r in out.collect():
        if not r["n_removed"]:
            assert r["text"] == before[r["key"]]
        else:
            assert len(words_of(r["text"])) == r["n_words"] - r["n_removed"]


def line_brute(rows: list[tuple]) -> list[tuple]:
    """The same boundaries, everything else by dictionaries."""
    cut = {}
    for _, text, *_ in rows:
        import pyarrow as pa

        for _, raw, spans in lines.row_chunks(pa.array([text])):
            cut[text] = [(raw[s:e], n) for s, e, n in spans]
    keeper = {}
    for i, text, *_ in rows:
        for chunk, n in cut[text]:
            if n >= 2:
                keeper[chunk] = min(keeper.get(chunk, lines.NO_ID), lines.NO_ID if i is None else i)
    out = []
    for i, text, *_ in rows:
        kept, seen, gone = [], set(), 0
        for chunk, n in cut[text]:
            if n >= 2 and (chunk in seen or keeper[chunk] != (lines.NO_ID if i is None else i)):
                gone += n
            else:
                kept.append(chunk)
                seen.add(chunk)
        out.append((i, None if text is None else b"\n".join(kept).decode(), 0 if text is None else sum(n for _, n in cut[text]), gone))
    return sorted(out, key=repr)


def test_lines(docs):
    rows = lines.dedup_lines(docs).collect()
    assert by_row(rows, ["doc_id", "text", "n_lines", "n_removed"]) == line_brute(corpus())
    assert any(r["n_removed"] for r in rows)
    light = lines.dedup_lines(docs, digest_only=True).collect()
    want = [(r["doc_id"], None if r["text"] is None else hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows]
    assert by_row(light, ["doc_id", "kept_sha256"]) == sorted(want, key=repr)


def test_line_boundaries_resist_shifts():
    import pyarrow as pa

    def chunks(text):
        return [raw[s:e] for _, raw, spans in lines.row_chunks(pa.array([text])) for s, e, _ in spans]

    own = [f"line {i} {i * i}" for i in range(200)]
    first, second = chunks("\n".join(own)), chunks("\n".join(["new", *own]))
    assert len(set(first) - set(second)) <= 1
    assert "\n".join(own).encode() == b"\n".join(first)
    assert max(c.count(b"\n") + 1 for c in chunks("same\n" * 500)) <= lines.MAX_LINES


def test_empty_tables(empty):
    assert sharding.shard_by_bytes(empty, 16).collect() == []
    assert packing.pack_documents(empty, VOCABULARY).collect() == []
    assert bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).collect() == []
    assert substrings.dedup_substrings(empty).collect() == []
    assert lines.dedup_lines(empty).collect() == []
