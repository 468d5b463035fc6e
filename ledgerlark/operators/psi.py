"""Population stability index per variable, all variables in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.quantiles import exact_quantiles

BINS = 10
COUNT_FLOOR = 1e-4


def long_form(df: DataFrame, variables: list[str]) -> DataFrame:
    """(variable, value) rows without missing values."""
    doubles = df.select(*[F.col(v).cast("double").alias(v) for v in variables])
    return (
        doubles.unpivot([], variables, "variable", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def bin_edges(
    baseline: DataFrame,
    bins: int = BINS,
    accuracy: int | None = None,
) -> DataFrame:
    """(variable, edges): distinct quantile edges of the baseline, in order.

    Exact by default. With ``accuracy`` the edges are approximate, within 1/accuracy of
    their rank, in one map-side combined pass.
    """
    steps = [i / bins for i in range(bins + 1)]
    if accuracy is None:
        cuts = exact_quantiles(baseline, "value", steps, "variable")
    else:
        cuts = baseline.groupBy("variable").agg(
            F.percentile_approx("value", steps, accuracy).alias("quantiles")
        )
    return cuts.select(
        "variable", F.array_sort(F.array_distinct("quantiles")).alias("edges")
    )


def inner_edges(edges: Column) -> Column:
    """Edges that separate bins. The outer two are open, so one or two edges mean one bin."""
    return F.when(
        F.size(edges) > 2, F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))
    ).otherwise(F.array().cast("array<double>"))


def bin_number(value: Column, inner: Column) -> Column:
    """Inner edges at or below the value; a value on an edge falls into the upper bin."""
    return F.size(F.filter(inner, lambda edge: edge <= value))


def bin_counts(edges: DataFrame, **samples: DataFrame) -> DataFrame:
    """(variable, bin, <sample>...) with every bin of every variable, empty ones as zero.

    Rows meet their variable's edges, one row per monitored variable, and are counted
    map-side, so only bin counts travel however uneven the variables are.
    """
    inner = edges.select("variable", inner_edges(F.col("edges")).alias("inner"))
    tagged = None
    for name, sample in samples.items():
        part = sample.join(inner, "variable").select(
            "variable",
            bin_number(F.col("value"), F.col("inner")).alias("bin"),
            *[F.lit(int(name == other)).alias(other) for other in samples],
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    counted = tagged.groupBy("variable", "bin").agg(
        *[F.sum(name).alias(name) for name in samples]
    )
    grid = inner.select(
        "variable", F.explode(F.sequence(F.lit(0), F.size("inner"))).alias("bin")
    )
    return grid.join(counted, ["variable", "bin"], "left").select(
        "variable", "bin", *[F.coalesce(name, F.lit(0)).alias(name) for name in samples]
    )


def psi_of_counts(counts: DataFrame, keys: Sequence[str] = ("variable",)) -> DataFrame:
    """(keys, psi) from bin counts ``expected`` and ``actual``.

    Counts are floored before they become shares; a variable without values on either
    side has a PSI of zero.
    """
    whole = Window.partitionBy(*keys)
    floored = counts.withColumns(
        {
            "e": F.greatest(F.col("expected").cast("double"), F.lit(COUNT_FLOOR)),
            "a": F.greatest(F.col("actual").cast("double"), F.lit(COUNT_FLOOR)),
        }
    )
    shares = floored.withColumns(
        {"e": F.col("e") / F.sum("e").over(whole), "a": F.col("a") / F.sum("a").over(whole)}
    )
    present = (F.sum("expected") > 0) & (F.sum("actual") > 0)
    term = (F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))
    return shares.groupBy(*keys).agg(
        F.when(present, F.sum(term)).otherwise(F.lit(0.0)).alias("psi")
    )


def population_stability(
    expected: DataFrame,
    actual: DataFrame,
    edges: DataFrame | None = None,
    bins: int = BINS,
) -> DataFrame:
    """(variable, psi) of two long-form samples, on quantile bins of ``expected``."""
    if edges is None:
        edges = bin_edges(expected, bins)
    return psi_of_counts(bin_counts(edges, expected=expected, actual=actual))
