"""Jaccard join, quality, WARC, neighbours, fingerprints and the pipeline against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from ledgerlark.llm import fingerprints, jaccard, neighbours, quality, queries, warc
from ledgerlark.llm.links import components
from ledgerlark.session import scratch_path
from tests.llm.fixture import DOCS, by_row, corpus, prose, words_of

SF_DIR = "/root/testdata/sf0.001"
FOLD = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, k):
    words = words_of((text or "").translate(FOLD))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def linked(rows, k, percent):
    """(doc_id, set size, smallest id reachable) by comparing everything with everything."""
    sets = [shingles(r[1], k) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    names = {}
    for (i, *_), x in zip(rows, label):
        names[x] = min((n for n in (names.get(x), i) if n is not None), default=None)
    return sorted(((r[0], len(s), names[x]) for r, s, x in zip(rows, sets, label)), key=repr)


def variants(count, words):
    """Copies of one text with ever more words changed, and a few unrelated ones."""
    base = prose(77, words).split(" ")
    out = []
    for i in range(count):
        changed = list(base)
        for n in range(i % 9):
            changed[(i * 7 + n * 11) % words] = f"w{i}x{n}"
        out.append((1000 + i, " ".join(changed), "en", "", None, 0, None))
    return out + [(5000 + i, prose(900 + i, words), "en", "", None, 0, None) for i in range(5)]


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("block", [jaccard.BLOCK_SETS, 8])
def test_links(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rows = corpus() + variants(40, 90) + variants(12, 14)
    rows = [(n if n < 20 else r[0], *r[1:]) for n, r in enumerate(rows)] if block == 8 else rows
    got = jaccard.linked_documents(spark.createDataFrame(rows, DOCS).repartition(3), k, percent)
    assert by_row(got.collect(), ["doc_id", "n_shingles", "component_id"]) == linked(rows, k, percent)


def test_one_document_of_a_group_stays(spark):
    rows = corpus()
    out = jaccard.keep_one(spark.createDataFrame(rows, DOCS), 5, 80)
    assert out.columns == spark.createDataFrame([], DOCS).columns
    kept = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    groups = {c for i, n, c in linked(rows, 5, 80) if n and c is not None}
    empties = {i for i, n, c in linked(rows, 5, 80) if not n and i is not None}
    assert set(kept) == groups | empties


def test_linked_sets_keep_a_common_gram():
    draw = np.random.default_rng(4)
    for size in (3, 10, 12, 19, 20, 33, 60, 150, 700):
        for percent in (80, 90):
            for _ in range(60):
                a = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64))
                new = draw.integers(0, size * (100 - percent) // 100 + 2)
                gone = draw.permutation(len(a))[: draw.integers(0, size * (100 - percent) // 100 + 2)]
                b = np.unique(np.concatenate([np.delete(a, gone), draw.integers(0, 1 << 63, new, dtype=np.uint64)]))
                common = len(np.intersect1d(a, b))
                if not 100 * common >= percent * (len(a) + len(b) - common):
                    continue
                order = {g: r for r, g in enumerate(draw.permutation(np.union1d(a, b)).tolist())}
                kept = []
                for s in (a, b):
                    ranked = sorted(jaccard.prefix_of(s, percent).tolist(), key=order.get)
                    kept.append(set(ranked[jaccard.left_out(len(s), percent) :]))
                assert kept[0] & kept[1]


def test_prefix_tree_finds_every_partner():
    draw = np.random.default_rng(9)
    base = draw.integers(0, 400, 60)
    sets = [np.unique(np.where(draw.random(60) < rate, draw.integers(0, 400, 60), base)).tolist() for rate in draw.random(80) * 0.2]
    root = jaccard.Node([], 0)
    root.smallest = 1 << 60
    for i, s in enumerate(sets):
        want = {j for j in range(i) if 100 * len(set(s) & set(sets[j])) >= 80 * len(set(s) | set(sets[j]))}
        assert set(jaccard.partners(root, s, 80)) == want
        jaccard.insert(root, s, i)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


def test_quality_on_held_out_rows(spark):
    for name in ("documents", "labels"):
        assert queries.table(spark, "/root/testdata/sf0.1", name).columns
    documents = queries.table(spark, "/root/testdata/sf0.1", "documents")
    labels = queries.table(spark, "/root/testdata/sf0.1", "labels").groupBy("doc_id").agg({"quality": "max"})
    rows = quality.predict(documents, queries.table(spark, "/root/testdata/sf0.1", "labels")).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["predicted"] == r["max(quality)"] for r in held]) >= 0.98


def test_quality_scores_every_row(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 60)] + [(1, None, None), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.predict(docs, labels).collect()
    assert len(rows) == len(corpus()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    none = quality.predict(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.predict(docs.limit(0), labels).collect() == []
    assert quality.keep_good(docs, labels).columns == docs.columns


def page_rows():
    long, short = "x" * 1500, "y" * 999
    rows = [(1, "http://a", long), (2, None, long), (9, "http://b\r\nX: y", long), (9, "http://c", long), (3, "u", short), (4, "u", short)]
    rows += [(5, "u", None), (6, "u", ""), (None, "u", long), (None, "u", "z" * 1200), (None, "u", "z" * 1200), (7, "ü", "é" * 500), (8, "u", "é" * 500)]
    return rows


def test_warc(spark):
    pages = spark.createDataFrame([(*r, "extra", 1) for r in page_rows()], "page_id long, url string, html string, digest string, payload int")
    path = scratch_path(spark, "test-warc")
    warc.write_archive(pages, path)
    read = warc.read_archive(spark, path)
    rows = read.select("*", warc.record_bytes().alias("record"), warc.original_bytes().alias("original")).collect()
    newest = {}
    for i, _, html in page_rows():
        newest[html or ""] = max((n for n in (newest.get(html or ""), i) if n is not None), default=None)
    want = []
    for i, _, html in page_rows():
        data = (html or "").encode()
        again = len(data) >= 1000 and newest[html or ""] != i
        want.append((i, hashlib.sha1(data).hexdigest(), "revisit" if again else "response", newest[html or ""] if again else None))
    assert by_row(rows, ["page_id", "payload_digest", "record_type", "refers_to"]) == sorted(want, key=repr)
    for r in rows:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: ")).split()[1])
        assert rest[length:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n") and b"X: y" not in head.split(b"\r\n")
        http, _, body = rest[:length].partition(b"\r\n\r\n")
        assert body == (b"" if r["record_type"] == "revisit" else bytes(r["payload"]))
        assert bytes(r["original"]) == bytes(r["header"]) + bytes(r["payload"]) + b"\r\n\r\n"
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({html or "" for _, _, html in page_rows()})


def test_warc_gives_every_address_back(spark):
    urls = ["http://a\tb\x7f", "http://a%09b%7F", "http://a%b\n%25", "%\x00%00", "a\r\nX-Target-URI-Escaped: yes", "", None, "\u0085x\u2028y\x1f", "é%é", " x ", "$1\\\n"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, html string")
    path = scratch_path(spark, "test-warc")
    warc.write_archive(pages, path)
    assert [r["url"] for r in warc.read_archive(spark, path).orderBy("page_id").collect()] == urls
    warc.write_archive(pages.limit(0), f"{path}-none")
    assert warc.read_archive(spark, f"{path}-none").collect() == []


def test_warc_finds_damage(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string"), path)
    broken = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "CAST('c' AS BINARY) AS payload").collect()
    spark.createDataFrame(broken, "digest binary, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, path).collect()


def test_warc_sql(spark):
    got = queries.QUERIES["op8_warc"](spark, "/root/testdata/sf0.01").collect()
    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    cursor = con.execute(queries.SQL["op8_warc"])
    names = [c[0] for c in cursor.description]
    assert by_row(got, names) == sorted(cursor.fetchall(), key=repr)


def nearest_brute(rows, every, count):
    own = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v) or len(v) != 8:
            continue
        own[i] = min(own.get(i, v), v)
    out = []
    for i in own:
        if i % every == 0:
            near = sorted((-float(np.dot(np.float32(own[i]).astype(float), np.float32(own[j]).astype(float))), j) for j in own if j != i)
            out += [(i, n + 1, j, round(-s, 9)) for n, (s, j) in enumerate(near[:count])]
    return sorted(out)


def test_neighbours(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=8).astype("f4").tolist()) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(60)]
    rows += [(500, None), (501, [0.0] * 8), (502, [None] + [1.0] * 7), (503, [float("nan")] * 8), (504, [float("inf")] + [1.0] * 7), (None, rows[0][1]), (7, rows[7][1])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, cid string")
    got = neighbours.nearest(frame, 20, 20).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in sorted(got)] == nearest_brute(rows, 20, 20)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 2.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["vec_id"]) for r in neighbours.nearest(few, 20).collect()] == [(0, 1)]
    assert neighbours.nearest(few.limit(0), 20).collect() == []
    doubles = spark.createDataFrame([(0, [0.1, 0.7]), (1, [0.3, 0.2])], "vec_id long, embedding array<double>")
    assert [r["score"] for r in neighbours.nearest(doubles, 20).collect()] == [0.1 * 0.3 + 0.7 * 0.2]
    with pytest.raises(ValueError):
        neighbours.nearest(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>"), 20)


def test_neighbours_recall(spark):
    table = queries.table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], float)
    found = {}
    for r in neighbours.nearest(table, 20, 20).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = v @ v[q]
        score[q] = -9
        best = ids[np.lexsort((ids, -score))[:20]]
        hits += len(found[ids[q]] & set(best.tolist()))
        total += 20
    assert hits / total >= 0.9


def test_fingerprints(spark):
    rows = [r for r in corpus()]
    got = fingerprints.compare_edits(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for i, text, *_ in rows:
        if i is not None:
            by_id[i] = text or ""
    known = sorted(by_id)
    unique = [i for i in known if sum(r[0] == i for r in rows) == 1]
    for i in unique[:-1]:
        text, after = by_id[i], by_id[known[known.index(i) + 1]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = next(x for x in got if x["doc_id"] == i)
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = shingles_cased(text), shingles_cased(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(r[name] - true) <= 0.2, (i, name)
    prints = {}
    for i, text, *_ in rows:
        prints.setdefault(text or "", set()).update(r["fingerprint"] for r in got if r["doc_id"] == i and i in unique)
    assert all(len(p) <= 1 for p in prints.values())
    assert fingerprints.compare_edits(spark.createDataFrame([], DOCS)).collect() == []
    plan = fingerprints.with_fingerprint(spark.createDataFrame(rows, DOCS).selectExpr("coalesce(text, '') AS t"), "t", "f")
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def shingles_cased(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_estimates_follow_the_true_similarity(spark):
    base = prose(1, 400).split(" ")
    rows = [(n, " ".join(base[:n] + prose(5, 400 - n).split(" ")) if n < 400 else " ".join(base)) for n in range(0, 401, 40)]
    first = fingerprints.with_fingerprint(spark.createDataFrame(rows, "n int, t string"), "t", "f").collect()
    full = next(r["f"] for r in first if r["n"] == 400)
    frame = spark.createDataFrame([(r["n"], r["t"], r["f"], full) for r in first], "n int, t string, a string, b string")
    for r in frame.select("n", "t", fingerprints.likeness(frame["a"], frame["b"]).alias("l")).collect():
        a, b = shingles_cased(r["t"]), shingles_cased(" ".join(base))
        assert abs(r["l"] - len(a & b) / len(a | b)) <= 0.15


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        rows = docs.collect()
        assert docs.columns == columns, name
        assert 0 < len(rows) <= before
        docs, before = spark.createDataFrame(rows, docs.schema), len(rows)
    sets = [s for s in (shingles(r["text"], 5) for r in rows) if s]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows}
    assert sets
