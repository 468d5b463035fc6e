"""Streams whose rows change until the watermark has passed them."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.streaming.monitoring import trailing_latency, trailing_rows
from ledgerlark.streaming.tables import ReplacingTable, keep_current

START = dt.datetime(2024, 1, 1)
KIND = "id string, service string, ts timestamp_ntz, latency double"
ENDS = "to_timestamp(concat(CAST(ts AS STRING), 'Z'))"


def brute(events):
    """(service, ts) -> (requests, mean) over [ts - 60 s, ts] of the different ids."""
    seen = {e[0]: e for e in events}.values()
    out = {}
    for _, service, ts, _ in seen:
        own = [e[3] for e in seen if e[1] == service and 0 <= (ts - e[2]).total_seconds() <= 60]
        known = [v for v in own if v is not None]
        out[(service, ts)] = (len(own), sum(known) / len(known) if known else None)
    return out


def same(a, b):
    return a == b or a is not None and b is not None and (a != a and b != b or a == pytest.approx(b))


def test_rows_of_a_block():
    draw = random.Random(1)
    at = np.array([draw.randrange(0, 120) * 500_000 for _ in range(200)])
    value = np.array([draw.random() for _ in at])
    present = np.array([draw.random() < 0.8 for _ in at])
    value[7] = float("nan")
    got = trailing_rows("s", 1, 30_000_000, at[at < 60_000_000], value[at < 60_000_000] * present[at < 60_000_000], present[at < 60_000_000], 31_000_000)
    assert got["at"].tolist() == sorted({int(t) for t in at if 31_000_000 <= t < 60_000_000})
    for t, n, total, count, nan in got[["at", "window_requests", "total", "n", "nan"]].itertuples(index=False):
        own = (at >= t - 30_000_000) & (at <= t)
        assert n == own.sum()
        assert same(float("nan") if nan else total / count if count else None, float(np.mean(value[own & present])) if (own & present).any() else None)


def test_rows_of_many_blocks():
    draw = random.Random(3)
    at = np.array([draw.randrange(-60, 240) * 500_000 for _ in range(150)])
    value = np.array([draw.random() for _ in at])
    present = np.array([draw.random() < 0.8 for _ in at])
    value[7] = float("nan")
    changed = at[[3, 40, 77]]
    got = trailing_rows("s", 0, 30_000_000, at, value * present, present, changed)
    want = {int(t) for t in at if t >= 0 and any(0 <= t - c <= 30_000_000 for c in changed)}
    assert got["at"].tolist() == sorted(want)
    for t, n, total, count, nan in got[["at", "window_requests", "total", "n", "nan"]].itertuples(index=False):
        own = (at >= t - 30_000_000) & (at <= t)
        assert n == own.sum()
        assert same(float("nan") if nan else total / count if count else None, float(np.mean(value[own & present])) if (own & present).any() else None)


def test_states_are_periods_not_minutes(spark, tmp_path):
    events = [(f"e{i}", "a", START + dt.timedelta(seconds=30 * i), float(i)) for i in range(80)]
    spark.createDataFrame(events, KIND).write.parquet(f"{tmp_path}/in/0")
    stream = spark.readStream.schema(KIND).parquet(f"{tmp_path}/in/*")
    rows = trailing_latency(stream, "service", "id", "ts", "latency", delay="2 hours")
    table = ReplacingTable(spark, f"{tmp_path}/table", rows.schema, ["service", "ts"])
    run = keep_current(rows, table, f"{tmp_path}/checkpoint")
    run.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress) == 5  # 40 minutes, and the one to come
    got = {(r["service"], r["ts"]): (r["window_requests"], r["rolling_mean"]) for r in table.read(ENDS, "2 HOURS").collect()}
    assert got == brute(events)


def test_late_repeated_and_missing_requests(spark, tmp_path):
    def event(i, second, latency, service="a"):
        return (f"e{i}", service, START + dt.timedelta(seconds=second), latency)

    draw = random.Random(2)
    first = [event(i, draw.randrange(0, 400), draw.random()) for i in range(60)] + [event(90, 100, None), event(91, 101, float("nan"), "b"), event(92, 400, 1.0, "b")]
    late = [event(200, 350, 5.0), event(201, 399, 6.0), first[3], first[-1]]
    too_late = [event(300, 20, 100.0)]
    last = [event(400, 2_000, 1.0)]
    stream = spark.readStream.schema(KIND).parquet(f"{tmp_path}/in/*")
    rows = trailing_latency(stream, "service", "id", "ts", "latency", delay="2 minutes")
    table = ReplacingTable(spark, f"{tmp_path}/table", rows.schema, ["service", "ts"])
    for n, part in enumerate((first, late, too_late, last)):
        spark.createDataFrame(part, KIND).write.parquet(f"{tmp_path}/in/{n}")
        keep_current(rows, table, f"{tmp_path}/checkpoint").awaitTermination()
        got = {(r["service"], r["ts"]): r for r in table.read(ENDS, "2 MINUTES").collect()}
        want = brute(first + late * (n > 0) + last * (n > 2))
        assert set(got) == set(want)
        for key, (requests, mean) in want.items():
            assert got[key]["window_requests"] == requests and same(got[key]["rolling_mean"], mean), key
        newest = max(k[1] for k in want)
        assert all(r["is_final"] == (k[1] <= newest - dt.timedelta(minutes=2)) for k, r in got.items())


def test_a_batch_taken_twice_changes_nothing(spark, tmp_path):
    kind = "k string, v int, day date, last_at timestamp"
    table = ReplacingTable(spark, str(tmp_path), spark.createDataFrame([], kind).schema, ["k"])
    assert table.read("last_at", "1 MINUTE").collect() == []

    def batch(*rows):
        return spark.createDataFrame([(k, v, START.date() + dt.timedelta(days=d), START) for k, v, d in rows], kind)

    table.take(batch(("a", 1, 0), ("b", 1, 1)), 0)
    for _ in range(2):
        table.take(batch(("a", 2, 0), ("c", 3, 2)), 1)
    table.take(batch().where(F.lit(False)), 2)
    rows = sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/rows").collect())
    assert rows == [("a", 2), ("b", 1), ("c", 3)]
