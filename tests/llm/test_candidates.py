import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.llm import jaccard
from ledgerlark.llm.common import text_key


def candidates(spark, texts, k, percent):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", text_key("text").alias("key"), "text")
    classes = jaccard.class_rows(docs, k)
    groups = jaccard.candidate_groups(docs.select("text"), classes, k, percent)
    return {r["doc_id"]: r["component"] for r in classes.join(groups, F.col("cid") == F.col("id")).collect()}


def test_chance_brings_no_large_group_together(spark):
    """Texts of few words share most three-word runs with some other text; only near copies are candidates."""
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(30)]
    texts = [draw.choices(words, k=150) for _ in range(600)]
    texts += [[*t[:75], "new", *t[76:]] for t in texts[:20]]
    found = candidates(spark, [" ".join(t) for t in texts], 3, 90)
    assert all(found[i] == found[600 + i] for i in range(20))
    sizes = [list(found.values()).count(c) for c in set(found.values())]
    assert max(sizes) < 30


def test_linked_sets_keep_a_common_pair():
    draw = np.random.default_rng(6)
    for size in (2, 9, 10, 12, 19, 20, 33, 60, 150, 700):
        for percent in (89, 90, 95, 99):
            for _ in range(60):
                a = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64))
                new = draw.integers(0, size * (100 - percent) // 100 + 2)
                gone = draw.permutation(len(a))[: draw.integers(0, size * (100 - percent) // 100 + 2)]
                b = np.unique(np.concatenate([np.delete(a, gone), draw.integers(0, 1 << 63, new, dtype=np.uint64)]))
                common = len(np.intersect1d(a, b))
                if np.array_equal(a, b) or not 100 * common >= percent * (len(a) + len(b) - common):
                    continue
                shared = jaccard.shared_percent(percent)
                keys = [jaccard.keys_of(s, percent) for s in (a, b)]
                both = set(np.intersect1d(*keys).tolist())
                assert all(100 * len(both) >= shared * len(k) for k in keys)
                kept = []
                for k in keys:
                    # The ones in common count as the commonest: the worst order there is.
                    ranked = sorted(jaccard.prefix_of(k, shared).tolist(), key=lambda x: (x not in both, x))
                    kept.append(set(ranked[jaccard.left_out(len(k), shared) :]))
                assert kept[0] & kept[1]
