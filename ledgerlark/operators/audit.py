"""Data-quality counts over the Bronze tables, one pass per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.parsing import iso_timestamp, parse_date, parse_double

# Fixed value: the wording of a warning. The names of the checks below are fixed too.
WARNING = "Data Quality Anomaly: %s = %d invalid/duplicate records detected."


def _surplus(key: str) -> Column:
    """Rows beyond the first of each key."""
    return F.count(key) - F.count_distinct(key)


def _unreadable(key: str, *parsed: Column) -> Column:
    """Rows with a key where any of the parsed columns is NULL."""
    bad = reduce(lambda a, b: a | b, [p.isNull() for p in parsed])
    return F.count_if(F.col(key).isNotNull() & bad)


def _null_keys(*keys: str) -> Column:
    return F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def checks() -> dict[str, dict[str, Column]]:
    """The 14 checks by table. User and session times must be year first here, although
    Silver also reads day-first times; NULL amounts count as invalid, NULL payment dates
    do not."""
    c = F.col
    return {
        "users": {
            "users_null_pk": _null_keys("user_id"),
            "users_duplicate_pk": _surplus("user_id"),
            "users_invalid_timestamps": _unreadable(
                "user_id",
                iso_timestamp(c("created_at")),
                iso_timestamp(c("updated_at")),
                iso_timestamp(c("ingestion_timestamp")),
            ),
        },
        "user_sessions": {
            "sessions_null_pk": _null_keys("session_id", "user_id"),
            "sessions_invalid_timestamp": _unreadable(
                "session_id", iso_timestamp(c("session_timestamp"))
            ),
        },
        "loans": {
            "loans_null_pk": _null_keys("loan_id", "user_id"),
            "loans_duplicate_pk": _surplus("loan_id"),
            "loans_invalid_disbursement_date": _unreadable(
                "loan_id", parse_date(c("disbursement_date"))
            ),
            "loans_invalid_amount": _unreadable("loan_id", parse_double(c("amount"))),
        },
        "loan_payments": {
            "payments_null_pk": _null_keys("payment_id", "loan_id"),
            "payments_duplicate_pk": _surplus("payment_id"),
            "payments_invalid_due_date": _unreadable("payment_id", parse_date(c("due_date"))),
            "payments_invalid_payment_date": F.count_if(
                c("payment_id").isNotNull()
                & c("payment_date").isNotNull()
                & parse_date(c("payment_date")).isNull()
            ),
            "payments_invalid_amounts": _unreadable(
                "payment_id", parse_double(c("amount_due")), parse_double(c("amount_paid"))
            ),
        },
    }


def audit_long(bronze: dict[str, DataFrame]) -> DataFrame:
    """(check, anomalies), 14 rows."""
    parts = []
    for table, named in checks().items():
        one_row = bronze[table].agg(*[c.alias(name) for name, c in named.items()])
        parts.append(one_row.unpivot([], list(named), "check", "anomalies"))
    return reduce(DataFrame.unionByName, parts)


def audit_wide(bronze: dict[str, DataFrame]) -> DataFrame:
    """One row, one column per check."""
    names = [name for named in checks().values() for name in named]
    return audit_long(bronze).agg(
        *[F.max(F.when(F.col("check") == n, F.col("anomalies"))).alias(n) for n in names]
    )


def audit_warnings(bronze: dict[str, DataFrame]) -> DataFrame:
    """(check, anomalies, warning) for each check that found something."""
    return audit_long(bronze).where("anomalies > 0").withColumn(
        "warning",
        F.format_string(WARNING, F.col("check"), F.col("anomalies")),
    )
