"""Parameters and metrics of training and drift runs as one long table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.clock import utc_now
from ledgerlark.functions.policy import drift_alert
from ledgerlark.schemas import RUN_METRICS
from ledgerlark.sources.lake import Lake


def run_rows(
    spark: SparkSession,
    run_id: str,
    params: Mapping[str, object] = {},
    metrics: Mapping[str, float] = {},
) -> DataFrame:
    """Driver-side values (a handful per run) as rows."""
    rows = [(run_id, None, "param", k, str(v), None) for k, v in params.items()]
    rows += [(run_id, None, "metric", k, None, float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, RUN_METRICS).drop("logged_at")


def drift_rows(metrics: DataFrame, run_id: str) -> DataFrame:
    """Weekly metrics turned into (run_id, kind, name, value, number) rows.

    Every variable has its PSI and alert; safety scores add their average, the injection
    score its rate, and the predicted probability its own drift flag.
    """
    var = F.col("variable_name")

    def entry(keep, name, value):
        return F.when(keep, F.struct(name.alias("name"), value.cast("double").alias("number")))

    always = F.lit(True)
    entries = F.array_compact(
        F.array(
            entry(always, F.concat(F.lit("psi_"), var), F.col("psi_value")),
            entry(always, F.concat(F.lit("alert_"), var), F.col("alert_triggered").cast("int")),
            entry(
                var == "probability_of_default",
                F.concat(F.lit("drift_alert_"), var),
                drift_alert(F.col("psi_value")).cast("int"),
            ),
            entry(F.col("avg_value").isNotNull(), F.concat(F.lit("avg_"), var), F.col("avg_value")),
            entry(
                var == "prompt_injection_score",
                F.lit("rate_prompt_injection"),
                F.col("rate_value"),
            ),
        )
    )
    return metrics.select(F.explode(entries).alias("e")).select(
        F.lit(run_id).alias("run_id"),
        F.lit("metric").alias("kind"),
        "e.name",
        F.lit(None).cast("string").alias("value"),
        "e.number",
    )


def track(lake: Lake, run_id: str, *rows: DataFrame) -> None:
    """Store a run's rows; what is stored under the same id is replaced."""
    run = reduce(DataFrame.unionByName, rows).withColumns(
        {"run_id": F.lit(run_id), "logged_at": utc_now()}
    )
    lake.replace_run(run)
