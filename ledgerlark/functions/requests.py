"""Validity of scoring requests and completeness of log rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def rejection_reasons() -> Column:
    """Why a request is invalid, as an array; empty for a valid one. NaN is out of range."""
    user, volume = F.col("user_id"), F.col("monthly_volume")
    days, income = F.col("session_regularity"), F.col("income")

    def broken(name: str, ok: Column) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))

    return F.array_compact(
        F.array(
            broken("user_id", F.length(user) >= 1),
            broken("monthly_volume", (volume >= 0) & ~F.isnan(volume)),
            broken("session_regularity", days.between(0, 30)),
            broken("income", (income >= 0) & ~F.isnan(income)),
        )
    )


# The fields a complete prediction log row must have.
MANDATORY_LOG_FIELDS = (
    "prediction_id", "user_id", "monthly_volume", "session_regularity",
    "income", "probability_of_default", "credit_limit", "decision",
    "latency_ms", "status",
)


def incomplete() -> Column:
    """Whether any mandatory field of a prediction log row is NULL."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in MANDATORY_LOG_FIELDS])
