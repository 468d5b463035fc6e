"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Each query is planned and run to a discarding sink twice; the second time counts, the
first is reported as ``first_run``. Training the full model (``gbt_scores``, a hundred trees one
after the other) would hide all others in the total and is not among them.
"""

from __future__ import annotations

import json
import os
import time

import registered
from ledgerlark.session import local_session

HEADLINE = (
    "silver_users", "silver_sessions", "silver_loans", "silver_payments",
    "audit_counts", "default_target", "gold_features", "cohort_alerts",
    "silver_upsert", "gold_merge_second_run",
    "stratified_split", "bounded_imputed_features", "model_evaluation",
    "credit_decisions", "request_validation", "scoring_fallback",
    "rolling_latency", "telemetry_summary", "psi_by_variable", "drift_week_comparison",
    "dialogue_scores", "stream_latency_windows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    first, second = {}, {}
    for seconds in (first, second):
        for name in HEADLINE:
            start = time.perf_counter()
            df = registered.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(os.environ.get("BENCH_CPUS", "8")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
