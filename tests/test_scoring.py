import pytest
from pyspark.sql import functions as F

from ledgerlark.plans import scoring, training
from ledgerlark.schemas import REQUESTS
from ledgerlark.sources.logs import log_predictions, prediction_rows


@pytest.mark.parametrize(
    "pd,income,limit,decision",
    [
        (0.15, 50000.0, 0.0, "REJECT"),
        (0.1000001, 50000.0, 0.0, "REJECT"),
        (0.10, 50000.0, 5000.0, "APPROVE_MEDIUM_RISK"),
        (0.08, 10000.0, 2000.0, "APPROVE_MEDIUM_RISK"),
        (0.06, 300000.0, 25000.0, "APPROVE_MEDIUM_RISK"),
        (0.04, 80000.0, 20000.0, "APPROVE_LOW_RISK"),
        (0.02, 10000.0, 5000.0, "APPROVE_LOW_RISK"),
        (0.01, 500000.0, 100000.0, "APPROVE_LOW_RISK"),
    ],
)
def test_policy(spark, pd, income, limit, decision):
    df = spark.createDataFrame([(pd, income)], "probability_of_default double, income double")
    row = scoring.decide(df).first()
    assert (row.credit_limit, row.decision, row.status) == (limit, decision, "SUCCESS")


@pytest.mark.parametrize("pd", [None, float("nan")])
def test_fallback(spark, pd):
    df = spark.createDataFrame([(pd, 9e5)], "probability_of_default double, income double")
    row = scoring.decide(df).first()
    assert tuple(row) == (0.08, 9e5, 2000.0, "FALLBACK_APPROVE", "FALLBACK")


def test_no_model_means_fallback(spark):
    requests = spark.createDataFrame([("u", 1.0, 2, 3.0)], REQUESTS)
    assert scoring.score(requests, None).first().status == "FALLBACK"


def test_validation(spark):
    rows = [
        ("ok", 0.0, 0, 0.0), ("ok30", 1.0, 30, 1.0), ("", 1.0, 1, 1.0), (None, 1.0, 1, 1.0),
        ("v", -10.0, 1, 1.0), ("r", 1.0, 35, 1.0), ("r-", 1.0, -1, 1.0), ("i", 1.0, 1, -5000.0),
        ("n", float("nan"), None, None), ("inf", float("inf"), 1, float("inf")),
    ]
    df = spark.createDataFrame(rows, REQUESTS)
    assert {r.user_id for r in scoring.valid_requests(df).collect()} == {"ok", "ok30", "inf"}
    reasons = {r.user_id: r.rejection_reasons for r in scoring.rejected_requests(df).collect()}
    assert reasons == {
        "": ["user_id"], None: ["user_id"], "v": ["monthly_volume"], "r": ["session_regularity"],
        "r-": ["session_regularity"], "i": ["income"],
        "n": ["monthly_volume", "session_regularity", "income"],
    }


LOG = (
    "prediction_id string, timestamp timestamp_ntz, user_id string, monthly_volume double, "
    "session_regularity int, income double, probability_of_default double, credit_limit double, "
    "decision string, latency_ms double, status string"
)
ROW = ("p1", None, "u", 1.0, 2, 3.0, 0.02, 5000.0, "APPROVE_LOW_RISK", 12.0, "SUCCESS")


def test_log_rows(spark):
    gaps = [ROW, ("p2", None, None, *ROW[3:]), ("p3", None, "u", None, *ROW[4:])]
    got = {r.prediction_id: r for r in prediction_rows(spark.createDataFrame(gaps, LOG)).collect()}
    assert {k: r.is_anomaly for k, r in got.items()} == {"p1": False, "p2": True, "p3": True}
    assert got["p2"].user_id == "UNKNOWN" and got["p1"].timestamp is not None
    given = spark.createDataFrame([ROW], LOG).withColumn("is_anomaly", F.lit(True))
    assert prediction_rows(given).first().is_anomaly


def test_log_is_idempotent(spark, lake):
    batch = spark.createDataFrame([ROW, ("p2", *ROW[1:]), ("p2", *ROW[1:])], LOG)
    log_predictions(lake, batch)
    log_predictions(lake, batch.unionByName(spark.createDataFrame([("p3", *ROW[1:])], LOG)))
    ids = [r.prediction_id for r in lake.read("gold", "prediction_logs").collect()]
    assert sorted(ids) == ["p1", "p2", "p3"]


def test_score_batch_logs_valid_and_returns_rejected(spark, lake):
    rows = [("p1", 9.0, "ok", 1.0, 2, 3.0), ("p2", 9.0, "ok", 1.0, 2, 3.0), ("p3", 9.0, "bad", -1.0, 2, 3.0), (None, 9.0, "ok", 1.0, 2, 3.0)]
    requests = spark.createDataFrame(rows, "prediction_id string, latency_ms double, user_id string, monthly_volume double, session_regularity int, income double")
    answers, rejected = scoring.score_batch(lake, requests, None)
    assert sorted((r.prediction_id, r.decision) for r in answers.collect()) == [("p1", "FALLBACK_APPROVE"), ("p2", "FALLBACK_APPROVE")]
    got = {r.prediction_id: r.rejection_reasons for r in rejected.collect()}
    assert got == {"p3": ["monthly_volume"], None: ["prediction_id"]}
    logged = lake.read("gold", "prediction_logs").collect()
    assert len(logged) == 2 and not any(r.is_anomaly for r in logged)
    for column in ("prediction_id", "latency_ms"):
        with pytest.raises(ValueError, match=column):
            scoring.score_batch(lake, requests.drop(column), None)


def test_missing_model_is_none(spark, tmp_path):
    assert training.load_model_if_any(spark, str(tmp_path / "none")) is None
