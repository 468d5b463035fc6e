"""Scoring, latency and drift over streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from ledgerlark.functions.clock import utc_instant, utc_wall
from ledgerlark.functions.policy import LATENCY_SLA_MS
from ledgerlark.operators.psi import bin_number, inner_edges, psi_of_counts
from ledgerlark.plans.scoring import score, valid_requests
from ledgerlark.plans.training import Model
from ledgerlark.sources.lake import Lake
from ledgerlark.sources.logs import log_predictions


def stream_predictions(
    lake: Lake,
    requests: DataFrame,
    model: Model | None,
    checkpoint: str,
) -> StreamingQuery:
    """Answer requests as they arrive, however late, and log each prediction id once.

    Repeats and repeated micro-batches are kept out by the log itself.
    """
    answers = score(valid_requests(requests), model)

    def append(batch: DataFrame, number: int) -> None:
        log_predictions(lake, batch)

    return (
        answers.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latency_windows(
    requests: DataFrame,
    service: str,
    ts: str,
    latency: str,
    length: str = "60 seconds",
    slide: str = "10 seconds",
    delay: str = "2 minutes",
) -> DataFrame:
    """Mean latency per service over sliding windows, with the warning flag."""
    return (
        requests.select(service, latency, utc_instant(F.col(ts)).alias("_at"))
        .withWatermark("_at", delay)
        .groupBy(service, F.window("_at", length, slide).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.avg(latency).alias("mean_latency"),
            F.max("_at").alias("last_at"),
        )
        .select(
            service,
            utc_wall(F.col("w.start")).alias("window_start"),
            utc_wall(F.col("w.end")).alias("window_end"),
            "requests",
            "mean_latency",
            (F.col("mean_latency") > LATENCY_SLA_MS).alias("sla_warning"),
            F.to_date(utc_wall(F.col("w.start"))).alias("day"),
            "last_at",
        )
    )


TRAILING_STATE = "ids array<string>, at array<long>, latency array<double>, present array<boolean>"


def trailing_latency(
    requests: DataFrame, service: str, request_id: str, ts: str, latency: str, seconds: int = 60, delay: str = "2 minutes",
    blocks: int = 10,
) -> DataFrame:
    """The exact mean over [ts - seconds, ts] at every instant of a service, as a stream in update mode.

    A request counts once however often it is sent; one that comes later than ``delay`` behind the newest
    event is left out. A row is sent again whenever a late request has changed it. A missing latency counts as
    a request but not in the mean; a NaN makes the means it falls into NaN.

    Time is cut into blocks as long as the range. A range is the end of one block and the beginning of the
    next, so a running sum from the front of a block and one from the back of the block before give it, by
    additions only. The state of a service is cut into periods of ``blocks`` blocks, each with the block before
    it, and dropped when the watermark has passed it. A state costs Python a call of its own, so many quiet
    services want long periods; a busy service is many states, side by side, and wants short ones.
    """
    span = seconds * 1_000_000
    at = F.col("at")
    block = F.expr(f"(at - pmod(at, {span}L)) DIV {span}L")
    period = F.expr(f"(block - pmod(block, {blocks}L)) DIV {blocks}L")
    # The last block of a period is also the one before the next period.
    periods = F.when(F.pmod(F.col("block"), F.lit(blocks)) == blocks - 1, F.array(period, period + 1)).otherwise(F.array(period))
    rows = (
        requests.where(F.col(ts).isNotNull())
        .select(
            F.col(service).cast("string").alias("service"),
            F.col(request_id).cast("string").alias("id"),
            utc_instant(F.col(ts)).alias("_at"),
            F.coalesce(F.col(latency).cast("double"), F.lit(0.0)).alias("latency"),
            F.col(latency).isNotNull().alias("present"),
        )
        .withWatermark("_at", delay)
        .withColumn("at", F.unix_micros("_at"))
        .withColumn("block", block)
        .select("service", "id", "_at", "at", "latency", "present", F.explode(periods).alias("period"))
    )

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name, own = key[0], int(key[1])
        if state.hasTimedOut:
            state.remove()
            return
        kept = [list(x) for x in state.get] if state.exists else [[], [], [], []]
        known, changed = set(kept[0]), []
        for frame in frames:
            for row in zip(*(frame[c].tolist() for c in ("id", "at", "latency", "present"))):
                if row[0] not in known:
                    known.add(row[0])
                    for values, value in zip(kept, row):
                        values.append(value)
                    changed.append(row[1])
        if not changed:
            return
        state.update(tuple(kept))
        # The watermark may be past the end already, when all of a period comes in its last batch.
        state.setTimeoutTimestamp(max((own + 1) * blocks * span // 1000, state.getCurrentWatermarkMs() + 1))
        _, at, latencies, present = kept
        found = trailing_rows(
            name, own * blocks, span, np.array(at), np.array(latencies), np.array(present, bool), np.array(changed)
        )
        if len(found):
            yield found

    kind = "service string, at long, window_requests long, total double, n long, nan boolean"
    found = rows.groupBy("service", "period").applyInPandasWithState(update, kind, TRAILING_STATE, "update", "EventTimeTimeout")
    wall = utc_wall(F.timestamp_micros(at))
    # A NaN would leave pandas as a NULL.
    mean = F.when(F.col("nan"), F.lit(float("nan"))).when(F.col("n") > 0, F.col("total") / F.col("n"))
    return found.select(
        F.col("service").alias(service),
        wall.alias(ts),
        "window_requests",
        mean.alias("rolling_mean"),
        (mean > LATENCY_SLA_MS).alias("sla_warning"),
        F.to_date(wall).alias("day"),
        F.timestamp_micros(at).alias("last_at"),
    )


def trailing_rows(
    name: str, block: int, span: int, at: np.ndarray, value: np.ndarray, present: np.ndarray, changed: int | np.ndarray
) -> pd.DataFrame:
    """Rows of the instants from ``block`` on that a request at one of the ``changed`` instants falls into.

    ``at``: the requests of these blocks and of the one before.
    """
    order = np.argsort(at, kind="stable")
    at, value, present = at[order], value[order], present[order]
    own = at // span
    last = np.flatnonzero(np.append(at[1:] != at[:-1], True))  # an instant's last request
    last = last[own[last] >= block]
    fresh = np.sort(np.atleast_1d(changed))
    newest = np.searchsorted(fresh, at[last], "right") - 1
    last = last[(newest >= 0) & (fresh[newest] >= at[last] - span)]
    first = np.searchsorted(at, at[last] - span)
    reaches = own[first] < own[last]
    edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(at)]
    sums = []
    for x in (value, present.astype(np.int64), np.ones(len(at), np.int64)):
        front, back = np.empty_like(x), np.empty_like(x)
        for a, b in zip(edges, edges[1:]):
            np.cumsum(x[a:b], out=front[a:b])
            np.cumsum(x[a:b][::-1], out=back[a:b][::-1])
        sums.append(front[last] + np.where(reaches, back[first], x.dtype.type(0)))
    nan = np.isnan(sums[0])
    return pd.DataFrame(
        {
            "service": name, "at": at[last], "window_requests": sums[2],
            "total": np.where(nan, 0.0, sums[0]), "n": sums[1], "nan": nan,
        }
    )


def weekly_bin_counts(
    logs: DataFrame, edges: DataFrame, variables: list[str], ts: str, delay: str = "1 hour"
) -> DataFrame:
    """(week, variable, bin, actual) from a stream of log rows and the baseline's edges.

    ``edges`` has one row per monitored variable; the state kept is one count per week,
    variable and bin.
    """
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value"))
                for v in variables
            ]
        )
    ).alias("pair")
    inner = edges.select("variable", inner_edges(F.col("edges")).alias("inner"))
    return (
        logs.select(utc_instant(F.col(ts)).alias("_at"), *variables)
        .withWatermark("_at", delay)
        .select("_at", pairs)
        .select("_at", "pair.variable", "pair.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .join(inner, "variable")
        .groupBy(
            F.window("_at", "7 days").alias("w"),
            "variable",
            bin_number(F.col("value"), F.col("inner")).alias("bin"),
        )
        .agg(F.count(F.lit(1)).alias("actual"), F.max("_at").alias("last_at"))
        .select(
            utc_wall(F.col("w.start")).alias("week"), "variable", "bin", "actual",
            F.to_date(utc_wall(F.col("w.start"))).alias("day"), "last_at",
        )
    )


def weekly_psi(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(week, variable, psi) from the weeks' counts and the baseline's (variable, bin, expected).

    Both sides are bin counts, so this is small whatever the traffic; each week and
    variable is spread over all bins of the baseline first.
    """
    weeks = actual.select("week", "variable").distinct()
    grid = weeks.join(expected, "variable")
    counts = grid.join(actual, ["week", "variable", "bin"], "left").withColumn(
        "actual", F.coalesce("actual", F.lit(0))
    )
    return psi_of_counts(counts, ["week", "variable"])
