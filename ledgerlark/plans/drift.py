"""Weekly drift and safety run over the logs."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.policy import drift_alert, drift_status
from ledgerlark.operators.psi import bin_counts, bin_edges, long_form, psi_of_counts
from ledgerlark.plans.dialogue import safety_summary
from ledgerlark.plans.tracking import drift_rows, run_rows, track
from ledgerlark.session import scratch_scope, written
from ledgerlark.sources.lake import Lake
from ledgerlark.sources.logs import in_week, week_bounds

log = logging.getLogger(__name__)

PREDICTION_VARIABLES = [
    "monthly_volume", "session_regularity", "income", "probability_of_default",
]


def classified(psi: DataFrame) -> DataFrame:
    """(variable, psi) with its class and alert."""
    return psi.withColumns(
        {"drift_status": drift_status(F.col("psi")), "alert_triggered": drift_alert(F.col("psi"))}
    )


def baseline_profile(baseline: DataFrame, accuracy: int | None = None) -> DataFrame:
    """(variable, edges, expected): bin edges and rows per bin of the four variables.

    One row per variable, all that a weekly run needs of a baseline: compute it once, store
    it and pass it along.
    """
    values = long_form(baseline, PREDICTION_VARIABLES)
    edges = written(bin_edges(values, accuracy=accuracy), "baseline-edges")
    by_bin = F.sort_array(F.collect_list(F.struct("bin", "expected")))["expected"]
    counts = bin_counts(edges, expected=values).groupBy("variable").agg(by_bin.alias("expected"))
    return edges.join(counts, "variable")


def prediction_drift(predictions: DataFrame, profile: DataFrame) -> DataFrame:
    """PSI rows of the four monitored variables; one without values is STABLE at 0.0."""
    actual = bin_counts(
        profile.select("variable", "edges"), actual=long_form(predictions, PREDICTION_VARIABLES)
    )
    expected = profile.select("variable", F.posexplode("expected").alias("bin", "expected"))
    psi = psi_of_counts(expected.join(actual, ["variable", "bin"]))
    # One row per monitored variable, from a count that is there even for an empty week.
    names = predictions.agg(*[F.count(v).alias(v) for v in PREDICTION_VARIABLES]).unpivot(
        [], PREDICTION_VARIABLES, "variable", "present"
    )
    filled = names.join(psi, "variable", "left").withColumn("psi", F.coalesce("psi", F.lit(0.0)))
    nothing = F.lit(None).cast("double")
    return classified(filled).select(
        F.col("variable").alias("variable_name"),
        F.col("psi").alias("psi_value"),
        nothing.alias("avg_value"),
        nothing.alias("rate_value"),
        "drift_status",
        "alert_triggered",
    )


def weekly_metrics(
    predictions: DataFrame,
    dialogues: DataFrame,
    profile: DataFrame,
    reference_date: str | dt.date,
) -> DataFrame:
    """Seven rows: four prediction variables and three safety scores."""
    week = in_week(predictions, reference_date)
    rows = prediction_drift(week, profile).unionByName(
        safety_summary(in_week(dialogues, reference_date))
    )
    stamp = F.lit(str(reference_date)).cast("timestamp_ntz")
    return rows.select(
        F.sha2(F.concat_ws("|", F.lit(str(reference_date)), "variable_name"), 256).alias(
            "metric_id"
        ),
        stamp.alias("timestamp"),
        "*",
    )


def overall_alert(metrics: DataFrame) -> DataFrame:
    """One row: whether any metric alerts, and how many do."""
    return metrics.agg(
        F.coalesce(F.bool_or("alert_triggered"), F.lit(False)).alias("alerts_triggered"),
        F.count_if("alert_triggered").alias("alerting_metrics"),
    )


def run_weekly_drift(
    lake: Lake, reference_date: str | dt.date, profile: DataFrame
) -> dict[str, object]:
    """Compute, store (replacing the same day) and track one week's metrics."""
    with scratch_scope(lake.spark):
        return _run_week(lake, reference_date, profile)


def _run_week(lake, reference_date, profile) -> dict[str, object]:
    predictions = lake.read("gold", "prediction_logs")
    dialogues = lake.read("gold", "dialogue_logs")
    metrics = written(
        weekly_metrics(predictions, dialogues, profile, reference_date), "drift-metrics"
    )
    lake.replace_drift_metrics(metrics)
    start, end = week_bounds(reference_date)
    summary = {
        "reference_date": str(reference_date),
        "start_date": start,
        "end_date": end,
        "total_predictions": in_week(predictions, reference_date).count(),
        "total_dialogues": in_week(dialogues, reference_date).count(),
    }
    run_id = f"drift_analysis_{reference_date}"
    track(lake, run_id, run_rows(lake.spark, run_id, summary), drift_rows(metrics, run_id))
    rows = [r.asDict() for r in metrics.collect()]
    for r in rows:
        if r["alert_triggered"]:
            log.warning("[ALERT] %s drifted or is unsafe: %s", r["variable_name"], r)
    summary["metrics"] = {r["variable_name"]: r for r in rows}
    summary["alerts_triggered"] = any(r["alert_triggered"] for r in rows)
    return summary


def compare_weeks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two weeks side by side per variable."""

    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            "variable_name",
            *[
                F.col(c).alias(f"{prefix}_{c}")
                for c in ("psi_value", "avg_value", "rate_value", "drift_status", "alert_triggered")
            ],
        )

    return named(first, "first").join(named(second, "second"), "variable_name")
