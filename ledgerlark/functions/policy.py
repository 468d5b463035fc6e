"""Credit policy, fallback, drift classes: fixed thresholds as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the credit policy.
REJECT_ABOVE_PD = 0.10
MEDIUM_ABOVE_PD = 0.04
MEDIUM_SHARE, MEDIUM_FLOOR, MEDIUM_CEILING = 0.10, 2000.0, 25000.0
LOW_SHARE, LOW_FLOOR, LOW_CEILING = 0.25, 5000.0, 100000.0

# Fixed values of the fallback answer.
FALLBACK_PD = 0.08
FALLBACK_LIMIT = 2000.0
FALLBACK_DECISION = "FALLBACK_APPROVE"

# Fixed values of drift and safety monitoring.
DRIFT_PSI = 0.25
MODERATE_PSI = 0.1
TOXICITY_ALERT = 0.20
INJECTION_RATE_ALERT = 0.05
LATENCY_SLA_MS = 100.0


def _clamp(value: Column, floor: float, ceiling: float) -> Column:
    return F.least(F.greatest(value, F.lit(floor)), F.lit(ceiling))


def credit_limit(pd: Column, income: Column) -> Column:
    return (
        F.when(pd > REJECT_ABOVE_PD, F.lit(0.0))
        .when(pd > MEDIUM_ABOVE_PD, _clamp(income * MEDIUM_SHARE, MEDIUM_FLOOR, MEDIUM_CEILING))
        .otherwise(_clamp(income * LOW_SHARE, LOW_FLOOR, LOW_CEILING))
    )


def credit_decision(pd: Column) -> Column:
    return (
        F.when(pd > REJECT_ABOVE_PD, "REJECT")
        .when(pd > MEDIUM_ABOVE_PD, "APPROVE_MEDIUM_RISK")
        .otherwise("APPROVE_LOW_RISK")
    )


def usable(pd: Column) -> Column:
    """Whether a model answer can be used: present and a number."""
    return pd.isNotNull() & ~F.isnan(pd)


def drift_status(psi: Column) -> Column:
    return (
        F.when(psi >= DRIFT_PSI, "DRIFT").when(psi >= MODERATE_PSI, "MODERATE").otherwise("STABLE")
    )


def drift_alert(psi: Column) -> Column:
    return psi >= DRIFT_PSI
