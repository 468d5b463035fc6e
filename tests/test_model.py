import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.functions.features import bounded, synthetic_income
from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.operators.ranking import accuracy, class_curves, model_metrics
from ledgerlark.operators.running import running_totals
from ledgerlark.operators.split import stratified_split
from ledgerlark.operators.split import test_sizes as sizes_per_class
from ledgerlark.plans import training
from ledgerlark.schemas import FEATURES

GOLD = "user_id string, observation_date date, monthly_volume double, session_regularity int, target_default_30d int"


def scored(spark, labels, scores):
    return spark.createDataFrame(list(zip(labels, map(float, scores))), "label int, probability double")


def brute_metrics(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ks = max(abs(sum(p <= t for p in pos) / len(pos) - sum(n <= t for n in neg) / len(neg)) for t in scores)
    loss = -sum(math.log(s if y else 1 - s) for y, s in zip(labels, scores)) / len(labels)
    return auc, 2 * auc - 1, ks, sum((s > 0.5) == y for y, s in zip(labels, scores)) / len(labels), loss


@pytest.mark.parametrize(
    "labels,scores,auc,ks",
    [
        ([0] * 4 + [1] * 4, [0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9], 1.0, 1.0),
        ([0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8], 0.75, 0.5),
    ],
)
def test_known_metrics(spark, labels, scores, auc, ks):
    m = model_metrics(scored(spark, labels, scores)).first()
    assert (m.roc_auc, m.gini_index, m.ks_statistic) == (auc, 2 * auc - 1, ks)


@pytest.fixture(params=[1, 3, 40])
def partitions(spark, request):
    """Shuffle partitions, and with them the slices that running totals use."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_metrics_in_slices_match_brute_force(spark, partitions):
    rng = random.Random(5)
    labels = [int(rng.random() < 0.3) for _ in range(600)]
    # A third of all rows share one score, the rest is spread very unevenly.
    scores = [0.25 if i % 3 == 0 else round(rng.random() ** 4 * 0.98 + 0.01, 3) for i in range(600)]
    got = model_metrics(scored(spark, labels, scores)).drop("unscored_rows").first()
    assert list(got) == pytest.approx(list(brute_metrics(labels, scores)), abs=1e-12)


def test_rows_without_score_are_counted(spark):
    rows = [(0, 0.1), (1, 0.9), (1, 0.8), (0, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "label int, probability double")
    m = model_metrics(df).first()
    assert (m.roc_auc, m.accuracy, m.unscored_rows) == (1.0, 1.0, 2)
    assert model_metrics(df.where("label > 5")).first().unscored_rows == 0


def test_metrics_with_one_class(spark):
    m = model_metrics(scored(spark, [1, 1], [0.2, 1.0])).first()
    assert m.roc_auc is None and m.gini_index is None and m.ks_statistic == 0.0
    assert m.accuracy == 0.5 and m.log_loss == pytest.approx(-math.log(0.2) / 2, abs=1e-9)
    assert class_curves(scored(spark, [1], [0.2]), "label", "probability").first().negatives_cdf is None


def test_hard_accuracy(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (0, 0.0), (1, 1.0)], "y int, p double")
    assert accuracy(df, "y", "p").first().accuracy == 0.75


def test_running_totals_per_group_in_many_slices(spark, partitions):
    rows = [(g, float(v), v % 5 + 1) for g in ("a", "b") for v in range(0, 300, 1 if g == "a" else 7)]
    df = spark.createDataFrame(rows, "g string, v double, n int").repartition(5)
    got = {(r.g, r.v): (r.n_cum, r.n_total) for r in running_totals(df, "v", ["n"], "g").collect()}
    for g in ("a", "b"):
        total = 0
        mine = sorted((v, n) for h, v, n in rows if h == g)
        for v, n in mine:
            total += n
            assert got[(g, v)] == (total, sum(n for _, n in mine))


def test_quantiles_match_numpy(spark, partitions):
    rng = np.random.default_rng(3)
    data = {"x": rng.exponential(50, 211), "y": np.repeat([1.0, 2.0, 9.0], [80, 5, 2]), "z": np.array([4.5])}
    df = spark.createDataFrame(
        [(k, float(v)) for k, vs in data.items() for v in vs] + [("x", None), ("x", float("nan"))],
        "variable string, value double",
    )
    steps = [i / 10 for i in range(11)]
    got = {r.variable: r.quantiles for r in exact_quantiles(df, "value", steps, "variable").collect()}
    for k, vs in data.items():
        assert got[k] == pytest.approx(list(np.percentile(vs, [s * 100 for s in steps])), rel=1e-15)


def test_split_sizes_and_stability(spark):
    df = spark.createDataFrame([(f"k{i}", int(i < 5)) for i in range(20)], "user_id string, y int")
    assert {r.y: r.n_test for r in sizes_per_class(df, "y", 0.3).collect()} == {0: 4, 1: 2}
    one = stratified_split(df, "user_id", "y").orderBy("user_id").collect()
    other = stratified_split(df.repartition(9), "user_id", "y").orderBy("user_id").collect()
    assert one == other
    assert sum(r.is_test for r in one) == 6 and sum(r.is_test for r in one if r.y) == 2
    assert stratified_split(df, "user_id", "y", seed=1).orderBy("user_id").collect() != one


def test_split_is_exact_for_many_rows(spark):
    df = spark.range(5003).select(F.col("id").cast("string").alias("user_id"), (F.col("id") % 11 == 0).cast("int").alias("y"))
    counts = {(r.y, r.is_test): r["count"] for r in stratified_split(df, "user_id", "y").groupBy("y", "is_test").count().collect()}
    total, ones = math.ceil(0.3 * 5003), 455
    assert counts[(0, True)] + counts[(1, True)] == total
    assert abs(counts[(1, True)] - total * ones / 5003) < 1


def test_bounds_before_imputation(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(-100.0, 40.0, -1.0), (inf, -2.0, inf), (-inf, nan, nan), (None, inf, None), (5.0, 7.0, 9.0)],
        "monthly_volume double, session_regularity double, income double",
    )
    assert [tuple(r) for r in df.select(*[bounded(f) for f in FEATURES]).collect()] == [
        (0.0, 30.0, None), (None, 0.0, None), (0.0, None, None), (None, 30.0, None), (5.0, 7.0, 9.0),
    ]


def test_impute_uses_train_medians_only(spark):
    rows = [("a", 1.0, 1.0, None, False), ("b", 3.0, None, None, False), ("c", 900.0, 5.0, 70.0, True), ("d", None, None, None, True)]
    df = spark.createDataFrame(rows, "user_id string, monthly_volume double, session_regularity double, income double, is_test boolean")
    got = {r.user_id: tuple(r)[1:4] for r in training.impute(df).collect()}
    assert got == {"a": (1.0, 1.0, 0.0), "b": (3.0, 1.0, 0.0), "c": (900.0, 5.0, 70.0), "d": (2.0, 1.0, 0.0)}


def test_income_floor_and_spread(spark):
    df = spark.range(4000).select(F.lit(0.0).alias("v"), F.col("id").cast("string").alias("u"))
    noise = df.select(synthetic_income(F.col("v") + 1e9, F.col("u")).alias("x")).select(
        F.ln(F.col("x") - 1.5e9).alias("z")
    )
    stats = noise.agg(F.avg("z"), F.stddev("z")).first()
    assert stats[0] == pytest.approx(9.5, abs=0.05) and stats[1] == pytest.approx(0.5, abs=0.05)
    assert df.agg(F.min(synthetic_income(F.col("v"), F.col("u")))).first()[0] == 15000.0


def gold_rows(spark, rows):
    return spark.createDataFrame(rows, "user_id string, d string, monthly_volume double, session_regularity int, target_default_30d int").select(
        "user_id", F.col("d").cast("date").alias("observation_date"), "monthly_volume", "session_regularity", "target_default_30d"
    )


def test_good_model_passes_is_saved_and_tracked(spark, lake, tmp_path):
    lake.merge_gold(gold_rows(spark, [(f"g{i}", "2023-07-01", 1500.0 * i + 10, i % 31, int(i < 75)) for i in range(300)]), "2023-07-01")
    path = str(tmp_path / "model")
    metrics = training.train_pipeline(lake, "2023-07-01", path, run_id="r1", maxIter=20)
    assert metrics["gini_index"] >= 0.65 and metrics["ks_statistic"] >= 0.45
    tracked = {r.name: r for r in lake.read("gold", "run_metrics").collect()}
    assert tracked["roc_auc"].number == metrics["roc_auc"] and tracked["maxIter"].value == "20"
    model = training.load_model(path)
    rows = training.baseline_rows(lake.read("gold", "target_construction"), model)
    again = training.baseline_rows(lake.read("gold", "target_construction"), training.load_model(path))
    assert sorted(rows.collect()) == sorted(again.collect()) and rows.count() == 300


def test_noise_fails_the_gate_and_leaves_nothing(spark, lake, tmp_path):
    rng = random.Random(1)
    rows = [(f"n{i}", "2023-07-01", rng.random() * 1e4, rng.randrange(31), i % 2) for i in range(120)]
    lake.merge_gold(gold_rows(spark, rows), "2023-07-01")
    with pytest.raises(training.ModelRejected):
        training.train_pipeline(lake, "2023-07-01", str(tmp_path / "model"), maxIter=5)
    assert not (tmp_path / "model").exists()
    assert lake.read("gold", "run_metrics").count() == 0


def test_training_preconditions(spark, lake, tmp_path):
    def train(rows):
        lake.merge_gold(gold_rows(spark, rows), rows[0][1])
        training.train_pipeline(lake, rows[0][1], str(tmp_path / "model"))

    with pytest.raises(ValueError, match="no data"):
        training.train_pipeline(lake, "2020-01-01", str(tmp_path / "model"))
    with pytest.raises(ValueError, match="10 records"):
        train([(f"u{i}", "2023-01-01", 1.0, 1, i % 2) for i in range(9)])
    with pytest.raises(ValueError, match="both classes"):
        train([(f"u{i}", "2023-02-01", 1.0, 1, 0) for i in range(20)])


@pytest.mark.parametrize("gini,ks,ok", [(0.65, 0.45, True), (0.649, 0.9, False), (0.9, 0.449, False), (None, 0.0, False)])
def test_gate(gini, ks, ok):
    metrics = {"gini_index": gini, "ks_statistic": ks}
    if ok:
        training.gate(metrics)
    else:
        with pytest.raises(training.ModelRejected):
            training.gate(metrics)


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "target_default_30d int")
    assert training.class_weight(df).first()[0] == 3.0
    assert training.class_weight(df.where("target_default_30d = 0")).first()[0] == 1.0


def test_an_empty_gold_table_is_no_baseline(lake):
    with pytest.raises(ValueError):
        training.baseline_rows(lake.read("gold", "target_construction"), None)


def test_rows_are_dealt_over_the_cores_before_the_trees_are_fitted(spark, monkeypatch):
    class Stop(Exception):
        pass

    def noted(df, label):
        raise Stop(df.rdd.getNumPartitions())

    monkeypatch.setattr(training, "written", noted)
    rows = spark.range(0, 100, 1, 1).selectExpr(
        "id * 1D AS monthly_volume", "id % 31 AS session_regularity", "id * 2D AS income", f"id % 2 AS {training.LABEL}"
    )
    with pytest.raises(Stop) as stopped:
        training.fit(rows)
    assert stopped.value.args[0] == spark.sparkContext.defaultParallelism > 1
