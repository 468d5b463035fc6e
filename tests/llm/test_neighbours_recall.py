"""Recall of the neighbours on a table whose files are long, with a third of the vectors in one place."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerlark.llm import neighbours

SIZE, QUERIES, COUNT = 64, 100, 20


@pytest.mark.parametrize("rows", [50_000, 200_000])
def test_recall_with_a_hot_third(spark, tmp_path, rows):
    every = rows // QUERIES
    draw = np.random.default_rng(11)
    hot = np.arange(rows) % 3 == 0
    v = draw.normal(size=(rows, SIZE))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[hot] = v[0] + 0.3 * v[hot]
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype("f4")
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype="i4") * SIZE), pa.array(v.ravel()))
    pq.write_table(pa.table({"vec_id": np.arange(rows), "embedding": lists}), f"{tmp_path}/v.parquet", row_group_size=rows // 16)
    found = {}
    for r in neighbours.nearest(spark.read.parquet(f"{tmp_path}/v.parquet"), every, COUNT).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = {True: [], False: []}
    for i in range(0, rows, every):
        score = v.astype(float) @ v[i]
        score[i] = -9
        hits[bool(hot[i])].append(len(found[i] & set(np.argsort(-score)[:COUNT].tolist())) / COUNT)
    recall = {k: float(np.mean(x)) for k, x in hits.items()}
    print(recall, len(hits[True]), len(hits[False]))
    assert min(recall.values()) >= 0.9, recall


def test_fewer_are_compared_the_larger_the_table():
    """The bound acts at both sizes: entries compared with a query grow with the square root."""
    small, large = (n * neighbours.compared_share(n) for n in (50_000, 200_000))
    assert 1.9 * small < large < 2.1 * small and large < 200_000 / 30


def test_agreement_is_the_footrule_distance():
    draw = np.random.default_rng(3)
    lists = np.stack([draw.permutation(20)[:6] for _ in range(50)]).astype(np.int32)
    files = neighbours.InvertedFiles(lists, 20)
    for own in lists[:10]:
        place = lambda x: {p: i for i, p in enumerate(x)}
        want = [sum(abs(place(own).get(p, 6) - place(x).get(p, 6)) for p in range(20)) for x in lists]
        assert (6 * 7 - 2 * files.agreement(own)).tolist() == want
