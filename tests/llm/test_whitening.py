"""Whitening against exact integers and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerlark.llm import whitening

KIND = "vec_id long, embedding array<double>, n long, component string"


def brute(vectors: list[list[float]]):
    """n, sums, integer rows and the eigenvalues by fractions and numpy."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, dims = len(fit), len(fit[0])
    sums = [sum(r[d] for r in fit) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in fit) / n) for j in range(dims)] for i in range(dims)])
    values, directions = np.linalg.eigh(cov)
    return x, n, sums, values[::-1], directions[:, ::-1]


@pytest.mark.parametrize("scale", [1.0, 40.0, 1e6])
def test_against_fractions(spark, scale):
    draw = np.random.default_rng(int(scale))
    vectors = (draw.normal(size=(150, 5)) * np.arange(1, 6) * scale).tolist()
    vectors[3:40] = [vectors[2]] * 37  # a hot vector counts once
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf")] * 5, [1e300] * 5]
    rows = [(i, v, 7, "x") for i, v in enumerate(vectors)] + [(1000 + i, v, 7, "x") for i, v in enumerate(bad)]
    rows += [(None, vectors[0], 7, "x"), (0, vectors[1], 7, "x")]
    got = whitening.whiten(spark.createDataFrame(rows, KIND).repartition(3)).collect()
    assert len(got) == (len(vectors) + 2) * 5
    x, n, sums, values, directions = brute(vectors)
    assert {r["n"] for r in got} == {n} and {r["identity_error"] for r in got}.pop() < 1e-8
    assert {r["vec_id"] for r in got} == {None, *range(150)}
    sign = {}
    for r in got:
        if r["vec_id"] in (None, 0):
            continue
        own, c = x[r["vec_id"]], r["component"] - 1
        deviation = sum((n * a - s) ** 2 for a, s in zip(own, sums))
        assert r["deviation"] == (deviation if deviation < 2**63 else None)
        want = sum((a - s / n) * v for a, s, v in zip(own, sums, directions[:, c])) / math.sqrt(values[c])
        if abs(want) > 1e-3:
            assert sign.setdefault(c, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
        assert abs(abs(want) - abs(r["whitened"])) < 1e-6
        assert abs(r["explained"] / (values[c] / values.sum()) - 1) < 1e-6


def test_little_data(spark):
    def out(rows):
        return whitening.whiten(spark.createDataFrame(rows, KIND)).collect()

    assert out([]) == [] and out([(1, None, 0, "")]) == []
    assert out([(1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")]) == []  # no variance
    two = out([(1, [0.0, 0.0], 0, ""), (2, [1.0, 1.0], 0, "")])
    assert sorted(abs(r["whitened"]) for r in two) == pytest.approx([1, 1]) and {r["component"] for r in two} == {1}
    with pytest.raises(ValueError):
        out([(1, [1.0], 0, ""), (2, [1.0, 2.0], 0, "")])


def test_scatter_of_wide_entries():
    """Every place of a long, in several limbs."""
    draw = np.random.default_rng(1)
    y = draw.integers(0, 1 << 61, size=(100, 3), dtype=np.uint64)
    limbs = np.zeros((6, 3, 3), np.int64)
    whitening.add_scatter(limbs, y, 61)
    for d in range(3):
        for e in range(3):
            total = sum(int(limbs[k, d, e]) << (whitening.LIMB_BITS * k) for k in range(6))
            assert total == sum(int(a) * int(b) for a, b in zip(y[:, d], y[:, e]))
