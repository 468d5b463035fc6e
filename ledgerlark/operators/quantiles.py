"""Exact quantiles with linear interpolation, for any number of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.running import running_totals


def _between(low: Column, high: Column, part: Column) -> Column:
    """The point ``part`` of the way from low to high, computed from the nearer end."""
    gap = high - low
    return F.when(part < 0.5, low + gap * part).otherwise(high - gap * (F.lit(1.0) - part))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: str,
) -> DataFrame:
    """One row per group of ``by``: the quantiles as an array in the order asked for.

    The built-in exact percentile keeps all distinct values of a group in one buffer. Here
    equal values are counted map-side, ranks come from running totals, and each quantile is
    the smallest value whose rank reaches its position: a plain MIN.
    """
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(by, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counts, value, ["n"], by)
    size, seen = F.col("n_total"), F.col("n_cum")
    picks = []
    for i, p in enumerate(probabilities):
        position = (size - 1).cast("double") * F.lit(float(p))
        picks += [
            F.min(F.when(seen > F.floor(position), F.col(value))).alias(f"_low{i}"),
            F.min(F.when(seen > F.ceil(position), F.col(value))).alias(f"_high{i}"),
            F.max(position - F.floor(position)).alias(f"_part{i}"),
        ]
    return (
        ranked.groupBy(by)
        .agg(*picks)
        .select(
            by,
            F.array(
                *[
                    _between(F.col(f"_low{i}"), F.col(f"_high{i}"), F.col(f"_part{i}"))
                    for i in range(len(probabilities))
                ]
            ).alias("quantiles"),
        )
    )
