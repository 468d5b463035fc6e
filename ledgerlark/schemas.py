"""Fixed table layouts of the three layers.

Bronze columns are all strings, so a load never fails on a bad value. Silver
columns are typed. Timestamps carry no zone (``timestamp_ntz``), so results do not
depend on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "string": T.StringType(),
        "timestamp": T.TimestampNTZType(),
        "date": T.DateType(),
        "double": T.DoubleType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "boolean": T.BooleanType(),
        "binary": T.BinaryType(),
    }
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        required = kind.endswith("!")
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not required))
    return T.StructType(fields)


SILVER = {
    "users": _struct(
        "user_id string, created_at timestamp, country string, "
        "updated_at timestamp, ingestion_timestamp timestamp"
    ),
    "user_sessions": _struct(
        "session_id string, user_id string, session_timestamp timestamp"
    ),
    "loans": _struct(
        "loan_id string, user_id string, disbursement_date date, amount double, "
        "term_months int, updated_at timestamp, ingestion_timestamp timestamp"
    ),
    "loan_payments": _struct(
        "payment_id string, loan_id string, due_date date, payment_date date, "
        "amount_due double, amount_paid double, "
        "updated_at timestamp, ingestion_timestamp timestamp"
    ),
}

BRONZE = {
    name: T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    for name, schema in SILVER.items()
}

RAW_TABLES = tuple(SILVER)


@dataclass(frozen=True)
class SilverRule:
    """How one Bronze table becomes Silver.

    ``required`` columns must be non-null before deduplication, ``newest`` orders the
    versions of a key, ``valid`` columns must be non-null on the version kept.
    """

    key: str
    required: tuple[str, ...]
    newest: tuple[str, ...]
    valid: tuple[str, ...] = ()


SILVER_RULES = {
    "users": SilverRule("user_id", ("user_id",), ("updated_at", "ingestion_timestamp")),
    "user_sessions": SilverRule(
        "session_id", ("session_id", "user_id"), ("session_timestamp",)
    ),
    "loans": SilverRule(
        "loan_id",
        ("loan_id", "user_id"),
        ("updated_at", "ingestion_timestamp"),
        ("disbursement_date", "amount"),
    ),
    "loan_payments": SilverRule(
        "payment_id",
        ("payment_id", "loan_id"),
        ("updated_at", "ingestion_timestamp"),
        ("due_date",),
    ),
}

GOLD_TARGET = _struct(
    "user_id string!, observation_date date!, monthly_volume double!, "
    "session_regularity int!, target_default_30d int!"
)

PREDICTION_LOGS = _struct(
    "prediction_id string!, timestamp timestamp, user_id string!, "
    "monthly_volume double, session_regularity int, income double, "
    "probability_of_default double, credit_limit double, decision string, "
    "latency_ms double, status string, is_anomaly boolean"
)

DIALOGUE_LOGS = _struct(
    "dialogue_id string!, timestamp timestamp, user_id string!, user_query string, "
    "bot_response string, toxicity_score double, prompt_injection_score double, "
    "fidelity_score double"
)

DAILY_SKETCHES = _struct("variable string, n long, sketch binary")

DAILY_ACTIVITY = _struct("user_id string, volume double, active boolean")

AUDIT_COUNTS = _struct("check string, anomalies long, table_name string, load string")

AUDIT_KEYS = _struct("id string, load string, bucket int")

LOG_KEYS = _struct("id string, log_date date, bucket int")

DRIFT_METRICS = _struct(
    "metric_id string!, timestamp timestamp, variable_name string!, psi_value double!, "
    "drift_status string!, alert_triggered boolean"
)

RUN_METRICS = _struct(
    "run_id string!, logged_at timestamp, kind string!, name string!, value string, "
    "number double"
)

REQUESTS = _struct(
    "user_id string, monthly_volume double, session_regularity int, income double"
)

FEATURES = ("monthly_volume", "session_regularity", "income")
