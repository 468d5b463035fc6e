"""Rolling mean over a trailing time range, for services of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.clock import utc_instant


#: Sums of values, of how many there are and of requests.
SUMS = ("_total", "_n", "_requests")


def _totals(over=None) -> list[Column]:
    """The sums over a window or a group."""
    sums = [F.sum(c) for c in SUMS]
    return [s.over(over) if over is not None else s for s in sums]


def rolling_mean(
    df: DataFrame, service: str, ts: str, value: str, seconds: int = 60
) -> DataFrame:
    """(service, ts, window_requests, rolling_mean): the mean over [ts - seconds, ts].

    One row per service and instant, instants without any value included. A NULL counts as a
    request but not in the mean; a NaN makes the means it falls into NaN.

    A range is the end of its first second, the full seconds between, and the beginning of
    its last second. Running sums inside single seconds give the ends, a window over second
    totals in blocks of ``seconds`` the middle. Values are only ever added, never taken away
    again, and no task holds more than one block of a service's second totals or one second
    of its instants.
    """
    instants = (
        df.where(F.col(ts).isNotNull())
        .groupBy(service, ts)
        .agg(
            F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("_total"),
            F.count(value).alias("_n"),
            F.count(F.lit(1)).alias("_requests"),
        )
        .withColumn("_second", F.unix_seconds(utc_instant(F.col(ts))))
    )
    span = F.expr(f"INTERVAL {seconds} SECONDS")
    rows = instants.withColumn("_probe", F.lit(False))
    # Where each range starts: an empty row at that instant, named by the range's end.
    probes = rows.withColumns(
        {
            "_second": F.col("_second") - seconds, "_probe": F.lit(True), "_total": F.lit(0.0),
            "_n": F.lit(0).cast("long"), "_requests": F.lit(0).cast("long"),
        }
    )
    at = F.when(F.col("_probe"), F.col(ts) - span).otherwise(F.col(ts))
    one_second = Window.partitionBy(service, "_second").orderBy("_at", F.desc("_probe"))
    up_to = one_second.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = one_second.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # One window for both ends: an instant takes what is up to it, a probe what follows it.
    both = rows.unionByName(probes).withColumn("_at", at)
    ends = both.select(
        service, ts, "_second", "_probe",
        *[
            F.when(F.col("_probe"), after).otherwise(before).alias(c)
            for before, after, c in zip(_totals(up_to), _totals(onward), SUMS)
        ],
    )

    totals = instants.groupBy(service, "_second").agg(*[s.alias(c) for s, c in zip(_totals(), SUMS)])
    block = F.floor(F.col("_second") / seconds)
    blocks = totals.withColumn("_block", F.explode(F.array(block, block + 1)))
    between = (
        Window.partitionBy(service, "_block").orderBy("_second").rangeBetween(1 - seconds, -1)
    )
    middle = blocks.select(
        F.col(service).alias("_service"), F.col("_second").alias("_own"), "_block",
        *[F.coalesce(s, F.lit(0)).alias(f"{c}_between") for s, c in zip(_totals(between), SUMS)],
    ).where(F.col("_block") == F.floor(F.col("_own") / seconds)).drop("_block")
    # A second's middle meets its instants where the window has left them.
    same = ends[service].eqNullSafe(middle["_service"]) & (ends["_second"] == middle["_own"])
    lasts = ends.where(~F.col("_probe")).join(middle, same)
    lasts = lasts.select(service, ts, *[(F.col(c) + F.col(f"{c}_between")).alias(c) for c in SUMS])
    whole = (
        lasts.unionByName(ends.where("_probe").select(service, ts, *SUMS))
        .groupBy(service, ts)
        .agg(*[s.alias(c) for s, c in zip(_totals(), SUMS)])
    )
    return whole.select(
        service,
        ts,
        F.col("_requests").alias("window_requests"),
        F.when(F.col("_n") > 0, F.col("_total") / F.col("_n")).alias("rolling_mean"),
    )
