"""Bronze, Silver, Gold and cohort alerts run one after the other."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame

from ledgerlark.plans.cohorts import ALERT_RATE, cohort_default_rates, cohort_report
from ledgerlark.plans.daily import refresh_daily, window_features
from ledgerlark.plans.gold import gold_rows
from ledgerlark.plans.quality import audit_new_loads, audit_totals, warnings_of
from ledgerlark.plans.silver import to_silver
from ledgerlark.schemas import RAW_TABLES
from ledgerlark.session import written
from ledgerlark.sources.lake import Lake
from ledgerlark.sources.raw import load_bronze

log = logging.getLogger(__name__)


def refresh_silver(lake: Lake) -> dict[str, int]:
    """Clean the Bronze loads that Silver has not taken in yet and merge them by key.

    A load is a part of Bronze, so a stored row that is newer than the incoming one stays.
    Loads are marked once all tables are published; a run that dies before repeats them
    without harm. Returns Silver row counts.
    """
    new = {t: lake.loads(t) - lake.merged_loads(t) for t in RAW_TABLES}
    lake.upsert_silver(
        {t: to_silver(lake.read_loads(t, loads), t) for t, loads in new.items() if loads},
        keep_newer=True,
    )
    for table, loads in new.items():
        lake.mark_merged(table, loads)
    return {r["table"]: r["rows"] for r in lake.row_counts(["silver"]).collect()}


def run_audit(lake: Lake) -> dict[str, int]:
    """Count the loads that are new, log one warning per failed check over all loads; returns the
    failed checks (14 at most)."""
    audit_new_loads(lake)
    failed = warnings_of(audit_totals(lake)).collect()
    for r in failed:
        log.warning(r["warning"])
    return {r["check"]: r["anomalies"] for r in failed}


def build_gold(
    lake: Lake, observation_date: str | dt.date, as_of_date: str | dt.date | None = None
) -> dict[str, int]:
    """Features from the days of the window, of which only new or changed ones are read."""
    run_audit(lake)
    refresh_daily(lake, observation_date)
    features = window_features(lake, observation_date)
    rows = gold_rows(lake.layer("silver"), observation_date, as_of_date, features)
    return {"inserted_count": lake.merge_gold(rows, observation_date)}


def cohort_check(lake: Lake, observation_date: str | dt.date) -> tuple[DataFrame, str | None]:
    """Rates per registration month (a small frame) and the alert text, if any."""
    rates = written(
        cohort_default_rates(
            lake.read("gold", "target_construction"),
            lake.read("silver", "users"),
            observation_date,
        ),
        "cohorts",
    )
    report = cohort_report(rates, observation_date).first()["drift_report"]
    if report:
        log.warning("Registration cohorts above the %.0f%% default rate:\n%s", ALERT_RATE * 100, report)
    return rates, report


def run_pipeline(
    lake: Lake,
    observation_date: str | dt.date,
    source,
    as_of_date: str | dt.date | None = None,
    multi_line: bool = False,
    json_form: str = "array",
) -> dict[str, object]:
    """Load, clean, build Gold for one date and check its cohorts; the five summaries."""
    lake.create()
    ingested = load_bronze(lake, source, multi_line, json_form)
    silver = refresh_silver(lake)
    gold = build_gold(lake, observation_date, as_of_date)
    rates, report = cohort_check(lake, observation_date)
    return {
        "ingest_summary": ingested,
        "silver_summary": silver,
        "gold_summary": gold,
        "alerts_summary": [r.asDict() for r in rates.collect()],
        "drift_report": report,
    }
