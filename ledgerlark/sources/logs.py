"""Prediction and dialogue logs: completion, append, range reads."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.clock import utc_now
from ledgerlark.functions.requests import incomplete
from ledgerlark.operators.newest import newest_per_key
from ledgerlark.schemas import DIALOGUE_LOGS, PREDICTION_LOGS
from ledgerlark.session import located, scratch_scope, written
from ledgerlark.sources.lake import LOG_KEYS, Lake, path_exists

UNKNOWN_USER = "UNKNOWN"
WEEK_DAYS = 7


def _all_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, NULL where ``df`` has none of that name."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _filled(df: DataFrame) -> DataFrame:
    """A missing timestamp is now, a missing user is UNKNOWN."""
    return df.withColumns(
        {
            "timestamp": F.coalesce("timestamp", utc_now()),
            "user_id": F.coalesce("user_id", F.lit(UNKNOWN_USER)),
        }
    )


def prediction_rows(df: DataFrame) -> DataFrame:
    """Log rows; a row missing a mandatory field is an anomaly unless flagged by the caller."""
    rows = _all_columns(df, PREDICTION_LOGS)
    return _filled(rows.withColumn("is_anomaly", F.coalesce("is_anomaly", incomplete())))


def dialogue_rows(df: DataFrame) -> DataFrame:
    return _filled(_all_columns(df, DIALOGUE_LOGS))


def keys_table(table: str) -> str:
    return table.removesuffix("s") + "_keys"


def pending_folder(lake: Lake, table: str) -> str:
    return f"{lake.root}/pending/{table}"


def _append_new(lake: Lake, table: str, key: str, rows: DataFrame) -> None:
    """Append rows whose id is not logged yet, on whatever day: an id is logged once.

    Ids are looked up in a table of them, in the hash buckets that the batch has ids of. What is
    new is put down as a pending batch first, then appended to the log and to the ids; if that
    dies half-way, the next append finishes it before anything else. One writer at a time.
    """
    with scratch_scope(lake.spark):
        finish_pending(lake, table, key)
        dated = newest_per_key(rows, key, ["timestamp"]).withColumn(
            "log_date", F.to_date("timestamp")
        )
        batch = written(lake.bucketed(dated, key), f"batch-{table}")
        fresh = batch.join(known_ids(lake, table, batch).withColumnRenamed("id", key), key, "left_anti")
        path = f"{pending_folder(lake, table)}/{uuid.uuid4().hex}"
        fresh.write.parquet(path)
        taken = lake.spark.read.schema(fresh.schema).parquet(path)
        lake.append("gold", table, taken)
        _append_ids(lake, table, key, taken)
        _forget(lake, path)


def known_ids(lake: Lake, table: str, batch: DataFrame) -> DataFrame:
    """The logged ids of the buckets that ``batch`` has rows of; other buckets are not read."""
    touched = [r.bucket for r in batch.select("bucket").distinct().collect()]
    return lake.read("gold", keys_table(table)).where(F.col("bucket").isin(touched)).select("id")


def _append_ids(lake: Lake, table: str, key: str, rows: DataFrame) -> None:
    ids = rows.select(F.col(key).alias("id"), "log_date", "bucket")
    lake.append("gold", keys_table(table), ids.hint("rebalance", "bucket"))


def _forget(lake: Lake, path: str) -> None:
    files, target = located(lake.spark, path)
    files.delete(target, True)


def finish_pending(lake: Lake, table: str, key: str) -> int:
    """Append what batches that died half-way have not appended; returns how many there were.

    A batch that was not put down as a whole has appended nothing and is given up: whoever sent
    it sends it again.
    """
    files, folder = located(lake.spark, pending_folder(lake, table))
    found = files.listStatus(folder) if files.exists(folder) else ()
    for path in [status.getPath().toString() for status in found]:
        if path_exists(lake.spark, f"{path}/_SUCCESS"):
            rows = lake.spark.read.parquet(path)
            days = [r.log_date for r in rows.select("log_date").distinct().collect()]
            logged = lake.read("gold", table).where(F.col("log_date").isin(days)).select(key)
            lake.append("gold", table, rows.join(logged, key, "left_anti"))
            ids = known_ids(lake, table, rows).withColumnRenamed("id", key)
            _append_ids(lake, table, key, rows.join(ids, key, "left_anti"))
        _forget(lake, path)
    return len(found)


def compact_ids(lake: Lake, most_files: int = 64) -> None:
    """Rewrite buckets of the id tables that many small appends have cut into many files."""
    for table in LOG_KEYS:
        lake.compact("gold", table, most_files)


def log_predictions(lake: Lake, df: DataFrame) -> None:
    _append_new(lake, "prediction_logs", "prediction_id", prediction_rows(df))


def log_dialogues(lake: Lake, df: DataFrame) -> None:
    _append_new(lake, "dialogue_logs", "dialogue_id", dialogue_rows(df))


def week_bounds(
    reference_date: str | dt.date, days: int = WEEK_DAYS
) -> tuple[str, str]:
    """From midnight ``days`` before the reference date to its last full second."""
    end = dt.date.fromisoformat(str(reference_date))
    return f"{end - dt.timedelta(days=days)} 00:00:00", f"{end} 23:59:59"


def in_week(
    logs: DataFrame, reference_date: str | dt.date, ts: str = "timestamp"
) -> DataFrame:
    """Rows of the week ending at the reference date.

    The bounds reach the scan; stored logs are also pruned by their date partitions.
    """
    start, end = (F.lit(b).cast("timestamp_ntz") for b in week_bounds(reference_date))
    if "log_date" in logs.columns:
        logs = logs.where(F.col("log_date").between(start.cast("date"), end.cast("date")))
    return logs.where((F.col(ts) >= start) & (F.col(ts) <= end))
