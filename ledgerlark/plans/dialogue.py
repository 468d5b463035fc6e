"""Dialogues from conversation turns, scored for safety, and their summary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import text as scorers
from ledgerlark.functions.policy import INJECTION_RATE_ALERT, TOXICITY_ALERT, drift_status

SAFETY_VARIABLES = ["toxicity_score", "prompt_injection_score", "fidelity_score"]


def dialogue_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it, NULL if none comes.

    An equi-join on conversation and turn number, so a conversation of any length spreads
    over the cluster instead of being walked in one task.
    """
    asked = turns.where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("user_query")
    )
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("bot_response")
    )
    return asked.join(answered, ["conv_id", "turn"], "left")


def score_dialogues(
    dialogues: DataFrame,
    toxic_words: Iterable[str] | None = None,
    injection_patterns: Iterable[str] = scorers.INJECTION_PATTERNS,
    failure_patterns: Iterable[str] = scorers.FAILURE_PATTERNS,
) -> DataFrame:
    """Toxicity and injection of the question, fidelity of the answer."""
    return dialogues.withColumns(
        {
            "toxicity_score": scorers.toxicity_score(F.col("user_query"), toxic_words),
            "prompt_injection_score": scorers.prompt_injection_score(
                F.col("user_query"), injection_patterns
            ),
            "fidelity_score": scorers.fidelity_score(F.col("bot_response"), failure_patterns),
        }
    )


def safety_summary(dialogues: DataFrame) -> DataFrame:
    """(variable_name, psi_value, avg_value, rate_value, drift_status, alert_triggered).

    The reference populations of the safety scores are constants, which leaves PSI a single
    open bin holding everything on both sides: it is 0.0 for any week. Averages and the
    share of injections raise the alerts. Without dialogues fidelity counts as 1.0.
    """
    row = dialogues.agg(
        F.coalesce(F.avg("toxicity_score"), F.lit(0.0)).alias("toxicity_score"),
        F.coalesce(F.avg("prompt_injection_score"), F.lit(0.0)).alias("prompt_injection_score"),
        F.coalesce(F.avg("fidelity_score"), F.lit(1.0)).alias("fidelity_score"),
        F.coalesce(
            F.avg(F.when(F.col("prompt_injection_score").isNotNull(),
                         (F.col("prompt_injection_score") > 0).cast("double"))),
            F.lit(0.0),
        ).alias("injection_rate"),
    )
    name = F.col("variable_name")
    long = row.unpivot(["injection_rate"], SAFETY_VARIABLES, "variable_name", "avg_value")
    rate = F.when(name == "prompt_injection_score", F.col("injection_rate")).otherwise(F.lit(0.0))
    return long.select(
        "variable_name",
        F.lit(0.0).alias("psi_value"),
        "avg_value",
        rate.alias("rate_value"),
        drift_status(F.lit(0.0)).alias("drift_status"),
        (
            ((name == "toxicity_score") & (F.col("avg_value") > TOXICITY_ALERT))
            | ((name == "prompt_injection_score") & (rate > INJECTION_RATE_ALERT))
        ).alias("alert_triggered"),
    )
