"""Window features from what each day adds, so that a new date reads only its own day.

For every day and user one row holds what was disbursed and whether a session took place. Features of a date
add up the rows of its 31 days; active days are bits of a number, merged by OR and counted. Days that a
merge into Silver has changed are worked out again, others never.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.sums import amount_sum
from ledgerlark.plans.gold import FEATURE_WINDOW_DAYS, day
from ledgerlark.session import scratch_scope, written
from ledgerlark.sources.lake import DAY_TABLES, Lake


def window_days(observation_date: str | dt.date) -> list[dt.date]:
    end = dt.date.fromisoformat(str(observation_date))
    return [end - dt.timedelta(days=n) for n in range(FEATURE_WINDOW_DAYS, -1, -1)]


def activity_of(lake: Lake, days: list[dt.date]) -> DataFrame:
    """(user_id, volume, active, day) of the given days from Silver, whose files are in order of days."""
    first, last = day(min(days)), day(max(days))
    loans = lake.read("silver", "loans").where(F.col("disbursement_date").between(first, last))
    ts = F.col("session_timestamp")
    sessions = lake.read("silver", "user_sessions").where(
        (ts >= first.cast("timestamp_ntz")) & (ts < F.date_add(last, 1).cast("timestamp_ntz"))
    )
    rows = loans.select(
        "user_id", F.col("disbursement_date").alias("day"), "amount", F.lit(False).alias("active")
    ).unionByName(
        sessions.select(
            "user_id", F.to_date(ts).alias("day"), F.lit(None).cast("double").alias("amount"), F.lit(True).alias("active")
        )
    )
    return (
        rows.where(F.col("day").isin(days))
        .groupBy("user_id", "day")
        .agg(F.coalesce(amount_sum(F.col("amount")), F.lit(0.0)).alias("volume"), F.bool_or("active").alias("active"))
    )


def refresh_daily(lake: Lake, observation_date: str | dt.date) -> list[dt.date]:
    """Bring the rows of the date's window up to date; returns the days that were worked out.

    First the days that merges have changed since lose their mark, then those changes count as seen: a run
    that dies in between does so again. Then the days of the window without a mark are read from Silver.
    """
    for table in DAY_TABLES:
        unseen = lake.changes(table) - lake.seen_changes(table)
        if unseen:
            lake.unmark_days(lake.changed_days(table, unseen))
            lake.see_changes(table, unseen)
    marked = lake.marked_days()
    missing = [d for d in window_days(observation_date) if d not in marked]
    if missing:
        with scratch_scope(lake.spark):
            lake.replace_days(written(activity_of(lake, missing), "daily"), missing)
        lake.mark_days(missing)
    return missing


def window_features(lake: Lake, observation_date: str | dt.date) -> DataFrame:
    """(user_id, monthly_volume, session_regularity) from the days of the window."""
    obs = day(observation_date)
    rows = lake.read("gold", "daily_activity").where(F.col("day").between(F.date_sub(obs, FEATURE_WINDOW_DAYS), obs))
    bit = F.when(F.col("active"), F.expr(f"shiftleft(1L, datediff(DATE'{observation_date}', day))")).otherwise(F.lit(0).cast("long"))
    return rows.groupBy("user_id").agg(
        F.sum("volume").alias("monthly_volume"), F.bit_count(F.bit_or(bit)).cast("int").alias("session_regularity")
    )
