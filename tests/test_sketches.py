"""Sketches of days: their rank error, what a refresh reads, baselines from them."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.plans import drift
from ledgerlark.plans.sketches import RANK_ERROR, merged_sketches, quantiles, refresh_sketches, sketched_profile
from ledgerlark.sources.logs import log_predictions

KIND = "prediction_id string, timestamp timestamp_ntz, user_id string, monthly_volume double, session_regularity int, income double, probability_of_default double, latency_ms double"


def logs(spark, day, count, seed):
    draw = np.random.default_rng(seed)
    at = dt.datetime(2024, 1, day, 3)
    rows = [(f"{day}-{seed}-{i}", at, "u", float(draw.lognormal()), int(draw.integers(0, 5)), None if i % 7 == 0 else float(draw.normal()), 0.25, float("nan") if i % 11 == 0 else float(draw.exponential())) for i in range(count)]
    return rows, spark.createDataFrame(rows, KIND)


def test_merged_days_keep_the_rank_error(spark, lake):
    every = []
    for day, count in ((1, 6_000), (2, 50), (3, 9_000)):
        rows, frame = logs(spark, day, count, 1)
        every += rows
        log_predictions(lake, frame)
        assert refresh_sketches(lake) == [dt.date(2024, 1, day)]
    more, frame = logs(spark, 2, 3_000, 2)
    log_predictions(lake, frame)
    assert refresh_sketches(lake) == [dt.date(2024, 1, 2)] and refresh_sketches(lake) == []
    every += more
    ranks = [i / 50 for i in range(51)]
    merged = merged_sketches(lake, "2024-01-01", "2024-01-31").select("variable", "n", quantiles(F.col("sketch"), ranks).alias("q"))
    for variable, n, found in merged.collect():
        at = [f.strip().split()[0] for f in KIND.split(",")].index(variable)
        own = np.array([r[at] for r in every if r[at] is not None and r[at] == r[at]], float)
        assert n == len(own)
        for rank, value in zip(ranks, found):
            assert (own < value).mean() - RANK_ERROR <= rank <= (own <= value).mean() + RANK_ERROR


def test_a_sketched_baseline_is_close_to_the_exact_one(spark, lake):
    _, frame = logs(spark, 5, 8_000, 3)
    log_predictions(lake, frame)
    refresh_sketches(lake)
    got = {r["variable"]: r for r in sketched_profile(lake, "2024-01-01", "2024-01-09").collect()}
    exact = {r["variable"]: r for r in drift.baseline_profile(frame).collect()}
    assert set(got) == set(exact)
    for variable, own in exact.items():
        assert len(got[variable]["edges"]) == len(own["edges"]), variable
        assert len(got[variable]["expected"]) == len(own["expected"])
        total = sum(own["expected"])
        assert max(abs(a - b) for a, b in zip(got[variable]["expected"], own["expected"])) <= 4 * RANK_ERROR * total
    assert got["session_regularity"]["edges"] == exact["session_regularity"]["edges"]
    assert got["probability_of_default"]["expected"] == [8_000]


def test_an_empty_log(lake):
    assert refresh_sketches(lake) == [] and sketched_profile(lake, "2024-01-01", "2024-01-02").collect() == []
