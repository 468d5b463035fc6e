"""Each stage on awkward rows against brute force: its own input, all columns kept, names that clash."""

import hashlib

import pytest

import corpus_pipeline
from tests.llm.fixture import corpus, words_of
from tests.llm.test_other_operators import linked
from tests.llm.test_passages import brute
from tests.llm.test_text_operators import repeated

SF_DIR = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, n_removed int, n_lines int, n_words int, marks string"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, key, 5, 77, 88, 99, "m") for i, t, lang, key, *_ in corpus()]
    return spark.createDataFrame(rows, KIND).repartition(3)


def run(spark, name, docs):
    out = STAGES[name](spark, docs, SF_DIR)
    assert out.columns == docs.columns
    rows = out.collect()
    for r in rows:
        assert (r["n_removed"], r["n_lines"], r["n_words"], r["marks"]) == (77, 88, 99, "m")
    return rows


def test_lines(spark, docs):
    rows = run(spark, "line_dedup", docs)
    want = sorted(((i, t) for i, t, *_ in brute(corpus())), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=repr) == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_near_copies(spark, docs):
    rows = run(spark, "ngram_jaccard_join", docs)
    groups = {c for _, n, c in linked(corpus(), 5, 80) if n and c is not None}
    wordless = {i for i, n, _ in linked(corpus(), 5, 80) if not n and i is not None}
    assert {r["doc_id"] for r in rows} - {None} == groups | wordless


def test_substrings(spark, docs):
    rows = run(spark, "substring_dedup", docs)
    got = sorted(((r["doc_id"], hashlib.sha256(" ".join(words_of(r["text"])).encode()).hexdigest()) for r in rows), key=repr)
    assert got == sorted(((i, kept) for i, _, _, kept in repeated(corpus(), 35)), key=repr)


def test_quality(spark, docs):
    """Every row is judged, copies alike, and what stays is as it was."""
    rows = run(spark, "quality_classifier", docs)
    given = {(i, t) for i, t, *_ in corpus()}
    assert {(r["doc_id"], r["text"]) for r in rows} <= given
    kept = [r["text"] for r in rows]
    counts = {t: sum(x == t for _, x, *_ in corpus()) for t in kept}
    assert all(kept.count(t) == n for t, n in counts.items())


def test_packing(spark, docs):
    rows = STAGES["best_fit_packing"](spark, docs, SF_DIR).collect()
    assert sorted((r["doc_id"] for r in rows if r["piece"] == 0), key=repr) == sorted((i for i, *_ in corpus()), key=repr)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, docs, name):
    assert STAGES[name](spark, docs.limit(0), SF_DIR).collect() == []
