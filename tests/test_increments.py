"""What a new load or a new date costs: only its own rows are read."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.audit import audit_long
from ledgerlark.plans import gold
from ledgerlark.plans.daily import activity_of, refresh_daily, window_days, window_features
from ledgerlark.plans.medallion import build_gold, refresh_silver
from ledgerlark.plans.quality import audit_new_loads, audit_totals
from ledgerlark.schemas import RAW_TABLES
from ledgerlark.sources import demo
from ledgerlark.sources.raw import load_bronze

SF_DIR = "/root/testdata/sf0.001"
OBS = dt.date(2000, 7, 1)


def halves(spark):
    """Bronze in two loads that share keys."""
    bronze = demo.bronze(spark, SF_DIR)
    part = {t: F.pmod(F.xxhash64(*df.columns), F.lit(2)) for t, df in bronze.items()}
    return [{t: df.where(part[t] == n) for t, df in bronze.items()} for n in (0, 1)], bronze


def counted(df):
    return {r["check"]: r["anomalies"] for r in df.collect()}


def test_counts_add_up_and_earlier_loads_are_not_read(spark, lake):
    loads, bronze = halves(spark)
    load_bronze(lake, loads[0])
    assert audit_new_loads(lake) == {t: 1 for t in RAW_TABLES}
    before = {t: lake.loads(t) for t in RAW_TABLES}
    load_bronze(lake, loads[1])
    for table, names in before.items():  # gone: the second run must not need it
        for name in names:
            for f in lake.spark.read.parquet(f"{lake.path('bronze', table)}/load={name}").inputFiles():
                open(f.removeprefix("file://"), "wb").close()
    audit_new_loads(lake)
    assert counted(audit_totals(lake)) == counted(audit_long(bronze))
    assert audit_new_loads(lake) == {t: 0 for t in RAW_TABLES}


def test_a_count_that_died_is_repeated(spark, lake, monkeypatch):
    loads, bronze = halves(spark)
    for load in loads:
        load_bronze(lake, load)
        with monkeypatch.context() as m:

            def gone(_):
                raise OSError("gone")

            m.setattr(lake, "replace_audit_counts", gone)
            with pytest.raises(OSError):
                audit_new_loads(lake)
        audit_new_loads(lake)
    assert counted(audit_totals(lake)) == counted(audit_long(bronze))


def test_no_loads(lake):
    audit_new_loads(lake)
    assert set(counted(audit_totals(lake)).values()) == {0} and audit_totals(lake).count() == 14


def features(df):
    return {r["user_id"]: (round(r["monthly_volume"], 6), r["session_regularity"]) for r in df.collect()}


def fresh_features(lake, date):
    rows = gold.gold_rows(lake.layer("silver"), date)
    return {u: f for u, f in features(rows).items() if f != (0.0, 0)}


def test_a_new_date_works_out_its_own_day(spark, lake):
    load_bronze(lake, demo.bronze(spark, SF_DIR))
    refresh_silver(lake)
    assert refresh_daily(lake, OBS) == window_days(OBS)
    for days in (1, 2):
        date = OBS + dt.timedelta(days=days)
        assert refresh_daily(lake, date) == [date]
        want = fresh_features(lake, date)
        got = gold.gold_rows(lake.layer("silver"), date, features=window_features(lake, date))
        assert want and {u: f for u, f in features(got).items() if f != (0.0, 0)} == want
    assert refresh_daily(lake, OBS) == []


def test_only_changed_days_are_worked_out_again(spark, lake):
    kinds = "loan_id string, user_id string, disbursement_date string, amount string, term_months string, updated_at string, ingestion_timestamp string"
    talks = "session_id string, user_id string, session_timestamp string"

    def send(loans, sessions=()):
        load_bronze(lake, {
            "loans": spark.createDataFrame([(i, "u", d, a, "6", t, t) for i, d, a, t in loans], kinds),
            "user_sessions": spark.createDataFrame(list(sessions), talks),
            "users": [{"user_id": "u", "created_at": "2000-01-01", "updated_at": "2000-01-01"}],
        })
        refresh_silver(lake)

    send([("a", "2000-06-10", "10", "2000-06-10"), ("b", "2000-06-20", "5", "2000-06-20")], [("s", "u", "2000-06-20 10:00:00")])
    refresh_daily(lake, OBS)
    assert features(window_features(lake, OBS)) == {"u": (15.0, 1)}
    # A loan moves to another day, a second session comes in late, a day outside the window changes too.
    send([("a", "2000-06-12", "11", "2000-06-11"), ("c", "1999-01-01", "1", "2000-06-11")], [("t", "u", "2000-06-20 11:00:00"), ("w", "u", "2000-06-21 11:00:00")])
    assert refresh_daily(lake, OBS) == [dt.date(2000, 6, d) for d in (10, 12, 20, 21)]
    assert features(window_features(lake, OBS)) == {"u": (16.0, 2)}
    # The only row of a day leaves it.
    send([("a", "1999-01-02", "11", "2000-06-13")])
    assert refresh_daily(lake, OBS) == [dt.date(2000, 6, 12)]
    assert features(window_features(lake, OBS)) == {"u": (5.0, 2)}
    build_gold(lake, OBS)
    assert features(lake.read("gold", "target_construction")) == {"u": (5.0, 2)}


def test_a_day_is_pushed_to_the_scan_of_ordered_files(spark, lake):
    load_bronze(lake, demo.bronze(spark, SF_DIR))
    refresh_silver(lake)
    text = activity_of(lake, [OBS])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(disbursement_date,2000-07-01)" in text
    assert "GreaterThanOrEqual(session_timestamp,2000-07-01T00:00)" in text
    for path in lake.read("silver", "loans").inputFiles():
        days = [r[0] for r in spark.read.parquet(path).select("disbursement_date").collect()]
        assert days == sorted(days)
    shutil.rmtree(f"{lake.root}/bronze")
    assert refresh_daily(lake, OBS)  # Silver is enough
