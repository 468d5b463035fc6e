"""Quantiles of the logs from one mergeable sketch per day and variable.

A KLL sketch is a few KB whatever it has seen, and sketches merge into one of the same error. A day is read
once, when its number of log rows differs from what its sketches are of; everything over many days starts
from the sketches. Exact edges, ``operators.psi.bin_edges``, stay the default; these are for baselines that
are too long to sort.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.psi import BINS
from ledgerlark.plans.drift import PREDICTION_VARIABLES
from ledgerlark.plans.gold import day
from ledgerlark.session import scratch_scope, written
from ledgerlark.sources.lake import Lake

SKETCHED = [*PREDICTION_VARIABLES, "latency_ms"]
#: The size of a sketch. A rank read from it is off by less than RANK_ERROR of all rows with a probability
#: above 99 %, merged or not.
SKETCH_SIZE = 800
RANK_ERROR = 0.005


def day_sketches(logs: DataFrame, variables: list[str] = SKETCHED) -> DataFrame:
    """(variable, n, sketch, log_date): one row for each day and variable that has values.

    A task sends one sketch for each of its days and variables, however many rows it has of them.
    """
    doubles = logs.select("log_date", *[F.col(v).cast("double").alias(v) for v in variables])
    values = doubles.unpivot(["log_date"], variables, "variable", "value")
    return (
        values.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("variable", "log_date")
        .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch"))
        .select("variable", "n", "sketch", "log_date")
    )


def refresh_sketches(lake: Lake) -> list[dt.date]:
    """Sketch the days of the prediction log that have other rows than they had; returns these days."""
    logs = lake.read("gold", "prediction_logs")
    now = logs.groupBy("log_date").agg(F.count(F.lit(1)).alias("rows"))  # no column is read
    was = lake.read("gold", "daily_sketches").where("variable = '*'").select("log_date", F.col("n").alias("rows"))
    changed = now.join(was, ["log_date", "rows"], "left_anti").where("log_date IS NOT NULL").collect()
    if changed:
        days = [r.log_date for r in changed]
        with scratch_scope(lake.spark):
            own = logs.where(F.col("log_date").isin(days))
            # The mark of what a day's sketches are of is written with them.
            marks = lake.spark.createDataFrame([("*", r.rows, None, r.log_date) for r in changed], "variable string, n long, sketch binary, log_date date")
            lake.replace_sketches(written(day_sketches(own).unionByName(marks), "sketches"))
    return sorted(r.log_date for r in changed)


def merged_sketches(lake: Lake, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """(variable, n, sketch) over the days from first to last."""
    rows = lake.read("gold", "daily_sketches").where(F.col("log_date").between(day(first), day(last)) & (F.col("variable") != "*"))
    return rows.groupBy("variable").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketch: Column, ranks: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(r)) for r in ranks]))


def latency_percentiles(lake: Lake, ranks: list[float]) -> DataFrame:
    """(log_date, rank, latency_ms) of every day with a sketch."""
    rows = lake.read("gold", "daily_sketches").where("variable = 'latency_ms'")
    pairs = F.arrays_zip(F.array(*[F.lit(float(r)) for r in ranks]).alias("rank"), quantiles(F.col("sketch"), ranks).alias("latency_ms"))
    return rows.select("log_date", F.explode(pairs).alias("p")).select("log_date", "p.rank", "p.latency_ms")


def sketched_profile(lake: Lake, first: str | dt.date, last: str | dt.date, bins: int = BINS) -> DataFrame:
    """(variable, edges, expected) of a baseline of many days, as ``plans.drift.baseline_profile`` has it.

    Edges and the rows between them are read from the merged sketches; no log row is.
    """
    merged = merged_sketches(lake, first, last).where(F.col("variable").isin(PREDICTION_VARIABLES))
    steps = [i / bins for i in range(bins + 1)]
    merged = written(merged.withColumn("edges", F.array_sort(F.array_distinct(quantiles(F.col("sketch"), steps)))), "merged-sketches")
    profile = merged.select("variable", "edges", F.array(F.col("n")).alias("expected")).where(F.size("edges") <= 2)
    # One row per monitored variable. Ranks are asked for at constants only.
    for variable, edges in [(r.variable, r.edges) for r in merged.select("variable", "edges").collect() if len(r.edges) > 2]:
        # A value on an edge falls into the upper bin: what is below it ends just before the edge.
        before = F.array(*[F.lit(math.nextafter(e, -math.inf)) for e in edges[1:-1]])
        ends = F.concat(F.array(F.lit(0.0)), F.kll_sketch_get_rank_double("sketch", before), F.array(F.lit(1.0)))
        own = merged.where(F.col("variable") == variable).withColumn("ends", ends)
        share = F.transform(F.slice("ends", F.lit(2), F.size("ends") - 1), lambda e, i: e - F.get(F.col("ends"), i))
        expected = F.transform(share, lambda x: F.round(x * F.col("n")).cast("long"))
        profile = profile.unionByName(own.select("variable", "edges", expected.alias("expected")))
    return profile
