"""Per-user features and the 30-days-past-due target for one observation date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.sums import amount_sum

# Fixed values of the feature window and the target.
FEATURE_WINDOW_DAYS = 30
PERFORMANCE_WINDOW_MONTHS = 12
DEFAULT_DAYS_PAST_DUE = 30

# Silver columns that ``gold_rows`` reads.
READS = {
    "users": ("user_id",),
    "user_sessions": ("user_id", "session_timestamp"),
    "loans": ("loan_id", "user_id", "disbursement_date", "amount"),
    "loan_payments": ("loan_id", "due_date", "payment_date"),
}


def day(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def _midnight(d: Column) -> Column:
    return d.cast("timestamp_ntz")


def monthly_volume(loans: DataFrame, observation_date: str | dt.date) -> DataFrame:
    """Sum disbursed per user from 30 days before the observation date up to that day."""
    obs = day(observation_date)
    in_window = F.col("disbursement_date").between(F.date_sub(obs, FEATURE_WINDOW_DAYS), obs)
    return (
        loans.where(in_window)
        .groupBy("user_id")
        .agg(F.coalesce(amount_sum(F.col("amount")), F.lit(0.0)).alias("monthly_volume"))
    )


def session_regularity(sessions: DataFrame, observation_date: str | dt.date) -> DataFrame:
    """Distinct active days per user in the same window.

    The bounds are on the timestamp itself, not on a cast of it, so they reach the
    parquet scan. Distinct days are merged map-side: a user sends 31 rows per task at most.
    """
    obs = day(observation_date)
    ts = F.col("session_timestamp")
    start = _midnight(F.date_sub(obs, FEATURE_WINDOW_DAYS))
    end = _midnight(F.date_add(obs, 1))
    return (
        sessions.where((ts >= start) & (ts < end))
        .groupBy("user_id")
        .agg(F.count_distinct(F.to_date(ts)).cast("int").alias("session_regularity"))
    )


def days_past_due(as_of_date: str | dt.date | None = None) -> Column:
    """Days late when paid; days overdue as of ``as_of_date`` (today if None) when not."""
    today = F.current_date() if as_of_date is None else day(as_of_date)
    return F.datediff(F.coalesce(F.col("payment_date"), today), F.col("due_date"))


def defaulted_users(
    payments: DataFrame,
    loans: DataFrame,
    observation_date: str | dt.date,
    as_of_date: str | dt.date | None = None,
) -> DataFrame:
    """Users with a payment due in the next 12 months that ran over 30 days late.

    Only late payments matter to a maximum of 0/1 flags, so the others are dropped before
    any shuffle, and each loan is reduced to one row before the join: a loan holding a
    large share of all payments cannot skew it.
    """
    obs = day(observation_date)
    due = F.col("due_date")
    late_loans = (
        payments.where((due > obs) & (due <= F.add_months(obs, PERFORMANCE_WINDOW_MONTHS)))
        .where(days_past_due(as_of_date) > DEFAULT_DAYS_PAST_DUE)
        .select("loan_id")
        .distinct()
    )
    return (
        loans.select("loan_id", "user_id")
        .join(late_loans, "loan_id")
        .select("user_id")
        .distinct()
        .withColumn("target_default_30d", F.lit(1))
    )


def default_target(
    users: DataFrame,
    payments: DataFrame,
    loans: DataFrame,
    observation_date: str | dt.date,
    as_of_date: str | dt.date | None = None,
) -> DataFrame:
    late = defaulted_users(payments, loans, observation_date, as_of_date)
    return (
        users.select("user_id")
        .join(late, "user_id", "left")
        .select(
            "user_id",
            day(observation_date).alias("observation_date"),
            F.coalesce("target_default_30d", F.lit(0)).alias("target_default_30d"),
        )
    )


def gold_rows(
    silver: dict[str, DataFrame],
    observation_date: str | dt.date,
    as_of_date: str | dt.date | None = None,
    features: DataFrame | None = None,
) -> DataFrame:
    """One row per Silver user: features and target in a single plan.

    ``features`` (user_id, monthly_volume, session_regularity) takes the place of those worked out
    from Silver. Every side is grouped by ``user_id`` before its join, so the three joins share one
    partitioning and none of them can multiply rows.
    """
    if features is None:
        volume = monthly_volume(silver["loans"], observation_date)
        regularity = session_regularity(silver["user_sessions"], observation_date)
    late = defaulted_users(
        silver["loan_payments"], silver["loans"], observation_date, as_of_date
    )
    users = silver["users"].select("user_id")
    for side in [features] if features is not None else [volume, regularity]:
        users = users.join(side, "user_id", "left")
    return (
        users.join(late, "user_id", "left")
        .select(
            "user_id",
            day(observation_date).alias("observation_date"),
            F.coalesce("monthly_volume", F.lit(0.0)).alias("monthly_volume"),
            F.coalesce("session_regularity", F.lit(0)).alias("session_regularity"),
            F.coalesce("target_default_30d", F.lit(0)).alias("target_default_30d"),
        )
    )
