"""Scoring requests: validation, prediction, credit policy, fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import policy
from ledgerlark.functions.requests import rejection_reasons
from ledgerlark.plans.training import Model, predict
from ledgerlark.session import written
from ledgerlark.sources.lake import Lake
from ledgerlark.sources.logs import log_predictions


def with_reasons(requests: DataFrame) -> DataFrame:
    return requests.withColumn("rejection_reasons", rejection_reasons())


def valid_requests(requests: DataFrame) -> DataFrame:
    return with_reasons(requests).where(F.size("rejection_reasons") == 0).drop("rejection_reasons")


def rejected_requests(requests: DataFrame) -> DataFrame:
    return with_reasons(requests).where(F.size("rejection_reasons") > 0)


def decide(scored: DataFrame) -> DataFrame:
    """Add limit, decision and status from ``probability_of_default`` and ``income``.

    A row without a usable probability gets the fallback answer.
    """
    pd, income = F.col("probability_of_default"), F.col("income")
    ok = policy.usable(pd)
    return scored.withColumns(
        {
            "credit_limit": F.when(ok, policy.credit_limit(pd, income)).otherwise(
                F.lit(policy.FALLBACK_LIMIT)
            ),
            "decision": F.when(ok, policy.credit_decision(pd)).otherwise(
                F.lit(policy.FALLBACK_DECISION)
            ),
            "status": F.when(ok, "SUCCESS").otherwise("FALLBACK"),
            "probability_of_default": F.when(ok, pd).otherwise(F.lit(policy.FALLBACK_PD)),
        }
    )


def score_batch(
    lake: Lake, requests: DataFrame, model: Model | None
) -> tuple[DataFrame, DataFrame]:
    """Answer and log the valid requests; returns the answers, and the rejected with reasons.

    Every request brings its own ``prediction_id`` and ``latency_ms``: equal requests are
    different requests, and ids made here would change when a lost task is run again. A
    request whose id is NULL is rejected.
    """
    for needed in ("prediction_id", "latency_ms"):
        if needed not in requests.columns:
            raise ValueError(f"requests need a column {needed}")
    no_id = F.when(F.col("prediction_id").isNull(), F.array(F.lit("prediction_id")))
    checked = with_reasons(requests).withColumn(
        "rejection_reasons",
        F.concat(F.coalesce(no_id, F.array().cast("array<string>")), "rejection_reasons"),
    )
    ok = F.size("rejection_reasons") == 0
    # Written once: what is returned is what was logged, and the model runs once.
    answers = written(score(checked.where(ok).drop("rejection_reasons"), model), "answers")
    log_predictions(lake, answers)
    return answers, checked.where(~ok)


def score(requests: DataFrame, model: Model | None) -> DataFrame:
    """Answer valid requests, in batch or on a stream; without a model all fall back."""
    if model is None:
        scored = requests.withColumn("probability_of_default", F.lit(None).cast("double"))
    else:
        scored = predict(model, requests).drop("prediction")
    return decide(scored)
