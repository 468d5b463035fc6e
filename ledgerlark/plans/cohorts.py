"""Default rates per registration month, alerts and the text report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.plans.gold import day

# The alert threshold and the wording of the report.
ALERT_RATE = 0.15
REPORT_HEADER = (
    "# Diagnostic Drift Report — Cohort {date}\n\n"
    "Generated for observation cohort date: {date}\n"
    "Status: WARNING — High Default Rate Alert Triggered\n\n"
    "Potential shift in credit profile or adverse selection detected in the "
    "following cohorts:\n"
)
REPORT_LINE = (
    "- **Registration Month**: %s | **Default Rate**: %.2f%% | **Cohort Size**: %d users\n"
)


def cohort_default_rates(
    gold: DataFrame, users: DataFrame, observation_date: str | dt.date
) -> DataFrame:
    """Rate and size per registration month; users without a readable month form their own."""
    cohort = gold.where(F.col("observation_date") == day(observation_date)).select(
        "user_id", "target_default_30d"
    )
    month = F.substring_index(F.col("created_at").cast("string"), "-", 2)  # years can be longer
    months = users.select("user_id", month.alias("reg_month"))
    return (
        cohort.join(months, "user_id")
        .groupBy("reg_month")
        .agg(
            F.avg(F.col("target_default_30d").cast("double")).alias("default_rate"),
            F.count(F.lit(1)).alias("cohort_size"),
        )
    )


def cohort_alerts(rates: DataFrame) -> DataFrame:
    return rates.where(F.col("default_rate") > ALERT_RATE)


def cohort_report(rates: DataFrame, observation_date: str | dt.date) -> DataFrame:
    """One row holding the alert text; NULL when no cohort alerts.

    The lines gathered are one per calendar month with an alert, a few hundred at most
    whatever the number of users.
    """
    line = F.format_string(
        REPORT_LINE,
        F.coalesce("reg_month", F.lit("None")),
        F.bround(F.col("default_rate") * 100, 2),
        F.col("cohort_size"),
    )
    header = REPORT_HEADER.format(date=observation_date)
    lines = F.sort_array(F.collect_list(F.struct("reg_month", line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda r: r["line"]), "")
    return cohort_alerts(rates).agg(
        F.count(F.lit(1)).alias("alerting_cohorts"),
        F.when(F.count(F.lit(1)) > 0, F.concat(F.lit(header), body)).alias("drift_report"),
    )
