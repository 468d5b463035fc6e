"""Latency and outcome statistics over the prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.policy import LATENCY_SLA_MS
from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.operators.rolling import rolling_mean


def rolling_latency(
    requests: DataFrame, service: str, ts: str, latency: str, seconds: int = 60
) -> DataFrame:
    """Trailing mean latency per service and instant, with the warning flag."""
    return rolling_mean(requests, service, ts, latency, seconds).withColumn(
        "sla_warning", F.col("rolling_mean") > LATENCY_SLA_MS
    )


def latency_sla(requests: DataFrame, service: str, latency: str) -> DataFrame:
    """Requests, requests over the limit, share within it, and whether all were."""
    within = F.col(latency) <= LATENCY_SLA_MS
    return requests.groupBy(service).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~within).alias("over_sla"),
        F.avg(within.cast("double")).alias("compliance"),
        F.bool_and(within).alias("all_within_sla"),
    )


#: The latency percentiles of a day.
PERCENTILES = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def daily_summary(logs: DataFrame) -> DataFrame:
    """Per day: requests, mean and exact percentiles of latency, mean predicted PD, share of fallback answers.

    For percentiles of many days without sorting them, see ``plans.sketches``.
    """
    dated = logs.withColumn("log_date", F.to_date("timestamp"))
    days = dated.groupBy("log_date").agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("latency_ms").alias("mean_latency_ms"),
        F.avg("probability_of_default").alias("mean_pd"),
        F.avg((F.col("status") == "FALLBACK").cast("double")).alias("fallback_rate"),
        F.avg(F.col("is_anomaly").cast("double")).alias("anomaly_rate"),
    )
    latencies = dated.select("log_date", F.col("latency_ms").cast("double").alias("latency_ms"))
    cuts = exact_quantiles(latencies, "latency_ms", list(PERCENTILES.values()), "log_date")
    named = cuts.select(F.col("log_date").alias("_day"), *[F.col("quantiles")[i].alias(n) for i, n in enumerate(PERCENTILES)])
    return days.join(named, days["log_date"].eqNullSafe(named["_day"]), "left").drop("_day")
