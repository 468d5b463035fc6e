"""Exact model metrics from scored rows: AUC, Gini, KS, accuracy, log loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.running import running_totals
from ledgerlark.session import written

# Fixed value: how close to 0 or 1 a probability may come in the log loss.
LOG_LOSS_CLIP = 2.220446049250313e-16


def by_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, positives, negatives): one row per distinct score, counted map-side.

    Rows without a score, NULL or NaN, are one row with a NULL score.
    """
    number = F.col(score).cast("double")
    return scored.groupBy(F.when(~F.isnan(number), number).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )


def class_curves(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, the cumulative share of each class up to that score.

    Rows without a score are in no class.
    """
    return curves_of(by_score(scored, label, score).where("score IS NOT NULL"))


def curves_of(counts: DataFrame) -> DataFrame:
    ranked = running_totals(counts, "score", ["positives", "negatives"])

    def share(name: str):
        total = F.col(f"{name}_total")
        return F.when(total > 0, F.col(f"{name}_cum") / total).alias(f"{name}_cdf")

    return ranked.select("*", share("positives"), share("negatives"))


def model_metrics(
    scored: DataFrame,
    label: str = "label",
    score: str = "probability",
    threshold: float = 0.5,
) -> DataFrame:
    """One row with all five metrics of the scored rows, and how many rows have no score.

    AUC counts, for each positive, the negatives scored below it, ties half. It and Gini
    are NULL when a class is empty; KS is then 0.0. A hard prediction is 1 above the
    threshold.
    """
    counts = written(by_score(scored, label, score), "score-counts")
    unscored = counts.agg(
        F.coalesce(
            F.sum(F.when(F.col("score").isNull(), F.col("positives") + F.col("negatives"))), F.lit(0)
        ).alias("unscored_rows")
    )
    curves = curves_of(counts.where("score IS NOT NULL"))
    pos, neg = F.col("positives"), F.col("negatives")
    n_pos, n_neg = F.max("positives_total"), F.max("negatives_total")
    below = F.col("negatives_cum") - neg
    wins = F.sum(pos.cast("double") * (below + neg / F.lit(2.0)))
    pairs = n_pos.cast("double") * n_neg.cast("double")
    p = F.least(F.greatest("score", F.lit(LOG_LOSS_CLIP)), F.lit(1.0 - LOG_LOSS_CLIP))
    loss = -F.sum(pos * F.ln(p) + neg * F.ln(F.lit(1.0) - p))
    right = F.sum(F.when(F.col("score") > threshold, pos).otherwise(neg))
    both = pairs > 0
    gap = F.max(F.abs(F.col("negatives_cdf") - F.col("positives_cdf")))
    rows = (n_pos + n_neg).cast("double")
    metrics = curves.agg(
        F.when(both, wins / pairs).alias("roc_auc"),
        F.when(both, gap).otherwise(F.lit(0.0)).alias("ks_statistic"),
        F.when(rows > 0, right / rows).alias("accuracy"),
        F.when(rows > 0, loss / rows).alias("log_loss"),
    )
    return metrics.select(
        "*", unscored.scalar().alias("unscored_rows")
    ).select(
        "roc_auc",
        (F.lit(2.0) * F.col("roc_auc") - 1.0).alias("gini_index"),
        "ks_statistic",
        "accuracy",
        "log_loss",
        "unscored_rows",
    )


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows whose given hard prediction equals the label."""
    return df.agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy")
    )
