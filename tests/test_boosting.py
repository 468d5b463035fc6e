import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import boosting
from ledgerlark.operators.boosting import BoostedTrees, feature_cuts, fit_boosted_trees, sampled, tree_features
from ledgerlark.plans import training
from test_model import gold_rows

NAMES = ["a", "b", "c"]


def plain_tree(x, g, h, cuts, drawn, depth, step):
    """One tree by trying every cut on every row: a function from rows to leaf values."""
    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + 1.0)

    leaf = -step * g.sum() / (h.sum() + 1.0)
    best = (1e-6, None)
    if depth:
        everything = np.ones(len(g), bool)
        for f in drawn:
            missing = np.isnan(x[:, f])
            for cut in cuts[f]:
                for missing_left in (True, False):
                    left = np.where(missing, missing_left, x[:, f] < cut)
                    if min(h[left].sum(), h[~left].sum()) < 1.0:
                        continue
                    gain = score(left) + score(~left) - score(everything)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, missing_left, left))
    if best[1] is None:
        return lambda rows: np.full(len(rows), leaf)
    f, cut, missing_left, left = best[1]
    low = plain_tree(x[left], g[left], h[left], cuts, drawn, depth - 1, step)
    high = plain_tree(x[~left], g[~left], h[~left], cuts, drawn, depth - 1, step)
    return lambda rows: np.where(np.where(np.isnan(rows[:, f]), missing_left, rows[:, f] < cut), low(rows), high(rows))


def made_up(spark, n=2000, seed=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.exponential(50, n).round(1), rng.integers(0, 31, n), rng.normal(0, 1, n)]).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 1] / 6 - 2 + x[:, 2])))).astype(int)
    x[rng.random(n) < 0.1, 0] = np.nan
    x[::3, 2] = 0.25  # a third of all rows share a value
    rows = [(f"k{i}", *[None if np.isnan(v) and i % 2 else float(v) for v in x[i]], int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, a double, b double, c double, y int"), x, y


def test_equals_plain_numpy_trees(spark):
    df, x, y = made_up(spark)
    trees, depth, step, bins = 6, 4, 0.3, 16
    w = np.where(y == 1, 2.5, 1.0)
    weight = F.when(F.col("y") == 1, 2.5).otherwise(1.0)
    model = fit_boosted_trees(
        df, NAMES, "y", "k", weight, trees=trees, depth=depth, step=step, column_share=0.7, bins=bins
    )
    by_name = feature_cuts(df, NAMES, bins)
    cuts = [by_name[f] for f in NAMES]
    assert all(len(c) <= bins for c in cuts)
    order = {f"k{i}": i for i in range(len(y))}
    margin = np.zeros(len(y))
    for t in range(trees):
        seen = [order[r.k] for r in df.where(sampled(F.col("k"), 0.8, 42, t)).select("k").collect()]
        assert 0.75 < len(seen) / len(y) < 0.85
        p = 1 / (1 + np.exp(-margin))
        drawn = [NAMES.index(f) for f in tree_features(NAMES, 0.7, 42, t)]
        assert len(drawn) == 2
        grown = plain_tree(x[seen], ((p - y) * w)[seen], (p * (1 - p) * w)[seen], cuts, drawn, depth, step)
        margin = margin + grown(x)
    got = {r.k: r.p for r in model.with_probability(df, "p").collect()}
    assert [got[f"k{i}"] for i in range(len(y))] == pytest.approx(list(1 / (1 + np.exp(-margin))), abs=1e-7)


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, tmp_path):
    df, _, _ = made_up(spark, 400)
    fit = lambda rows: fit_boosted_trees(rows, NAMES, "y", "k", trees=3, depth=3)
    model = fit(df)
    assert fit(df.repartition(7, "b")) == model
    model.save(spark, str(tmp_path / "m"))
    model.save(spark, str(tmp_path / "m"))
    assert BoostedTrees.load(spark, str(tmp_path / "m")) == model


def test_constant_missing_infinite_and_unlabelled(spark):
    inf = float("inf")
    rows = [(str(i), 1.0, None, inf if i % 2 else -inf, i % 2) for i in range(60)] + [("u", 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, y int")
    model = fit_boosted_trees(df, NAMES, "y", "k", trees=4, depth=2, column_share=1.0)
    assert all(0.0 < r.p < 1.0 for r in model.with_probability(df, "p").collect())
    with pytest.raises(ValueError):
        fit_boosted_trees(df.where("y > 5"), NAMES, "y", "k")


def test_a_level_is_one_map_side_combined_aggregate(spark, monkeypatch):
    df, _, _ = made_up(spark, 300)
    plans = []
    histogram = boosting._histogram

    def noted(seen, where, drawn, unit):
        plans.append(seen)
        return histogram(seen, where, drawn, unit)

    monkeypatch.setattr(boosting, "_histogram", noted)
    fit_boosted_trees(df, NAMES, "y", "k", trees=7, depth=3)
    assert len(plans) <= 7 * 3
    text = plans[-1]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("Scan parquet") == 1
    columns = text.split("ReadSchema:")[1]
    assert "_y" in columns and sum(f"_bin_{f}" in columns for f in NAMES) <= 3


def test_full_parameters_reach_the_gate(spark, lake, tmp_path):
    rows = [(f"g{i}", "2023-07-01", 1500.0 * i + 10, i % 31, int(i < 75)) for i in range(300)]
    lake.merge_gold(gold_rows(spark, rows), "2023-07-01")
    path = str(tmp_path / "model")
    metrics = training.train_pipeline(lake, "2023-07-01", path, run_id="r2", learner="second_order")
    assert metrics["gini_index"] >= 0.65 and metrics["ks_statistic"] >= 0.45
    tracked = {r.name: r.value for r in lake.read("gold", "run_metrics").where("kind = 'param'").collect()}
    assert tracked["trees"] == "100" and tracked["learner"] == "second_order"
    model = training.load_model_if_any(spark, path)
    assert isinstance(model, BoostedTrees) and len(model.trees) == 100
    scored = training.baseline_rows(lake.read("gold", "target_construction"), model)
    assert scored.where("probability_of_default between 0 and 1").count() == 300


def test_few_cells_are_one_aggregate_a_tree_with_the_same_trees(spark, monkeypatch):
    df, _, _ = made_up(spark, 400)
    taken = []
    for name in ("_cell_sums", "_level_sums"):
        plain = getattr(boosting, name)
        monkeypatch.setattr(boosting, name, lambda *a, plain=plain, name=name: (taken.append(name), plain(*a))[1])
    fit = lambda: fit_boosted_trees(df, NAMES, "y", "k", trees=4, depth=4, bins=32)
    by_cells = fit()
    assert taken == ["_cell_sums"] * 4
    monkeypatch.setattr(boosting, "CELLS", 10)
    assert fit() == by_cells
    assert taken[4:] == ["_level_sums"] * 4
