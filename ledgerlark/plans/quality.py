"""Data-quality counts kept per load, so that a new load is the only one that is read.

Counts of bad rows add up over loads. Duplicates need the keys that earlier loads had: they are kept
once each in hash buckets, and a load's keys are looked up in the buckets it has keys of. What a load
adds to the surplus is its rows with a key less the keys that are new with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.audit import WARNING, checks
from ledgerlark.schemas import RAW_TABLES, SILVER_RULES
from ledgerlark.session import scratch_scope, written
from ledgerlark.sources.lake import Lake


def audit_new_loads(lake: Lake) -> dict[str, int]:
    """Count the loads that are not counted yet; returns how many there were of each table.

    A load that was counted must not be replaced. A run that dies is repeated without harm: keys it has
    put down name their load.
    """
    new = {t: lake.loads(t) - lake.audited_loads(t) for t in RAW_TABLES}
    for table, loads in new.items():
        if loads:
            with scratch_scope(lake.spark):
                counts = _counts(lake, table, loads)
                lake.replace_audit_counts(counts.withColumn("table_name", F.lit(table)))
    return {t: len(loads) for t, loads in new.items()}


def _counts(lake: Lake, table: str, loads: set[str]) -> DataFrame:
    """(load, check, anomalies) of the given loads: a row for each load and check of the table."""
    rows = lake.read_loads(table, loads, with_load=True)
    named = checks()[table]
    plain = {n: c for n, c in named.items() if not n.endswith("_duplicate_pk")}
    surplus = [n for n in named if n not in plain]
    aggregates = [c.alias(n) for n, c in plain.items()]
    key = SILVER_RULES[table].key
    if surplus:
        aggregates.append(F.count(key).alias(surplus[0]))
    by_load = rows.groupBy("load").agg(*aggregates)
    if surplus:
        fresh = new_keys(lake, table, rows.select(F.col(key).alias("id"), "load"), loads)
        by_load = by_load.join(fresh, "load", "left").withColumn(
            surplus[0], F.col(surplus[0]) - F.coalesce("fresh", F.lit(0))
        )
    return by_load.unpivot(["load"], list(named), "check", "anomalies")


def new_keys(lake: Lake, table: str, keys: DataFrame, loads: set[str]) -> DataFrame:
    """(load, fresh): the keys that the loads bring for the first time; these are put down."""
    first = keys.where("id IS NOT NULL").groupBy("id").agg(F.min("load").alias("load"))
    first = written(lake.bucketed(first, "id"), f"keys-{table}")
    touched = [r.bucket for r in first.select("bucket").distinct().collect()]
    known = lake.audit_keys(table).where(F.col("bucket").isin(touched)).select("id", F.col("load").alias("owner"))
    # A key that names one of these loads was put down by a run of them that died.
    status = written(
        first.join(known, "id", "left").where(F.col("owner").isNull() | F.col("owner").isin(sorted(loads))),
        f"new-keys-{table}",
    )
    lake.append_audit_keys(table, status.where("owner IS NULL").select("id", "load", "bucket"))
    return status.groupBy(F.coalesce("owner", "load").alias("load")).agg(F.count(F.lit(1)).alias("fresh"))


def audit_totals(lake: Lake) -> DataFrame:
    """(check, anomalies) over all counted loads, 14 rows."""
    spark = lake.spark
    names = [[(n,) for n in named] for named in checks().values()]
    every = spark.createDataFrame(reduce(list.__add__, names), "check string")
    totals = lake.audit_counts().groupBy("check").agg(F.sum("anomalies").alias("anomalies"))
    return every.join(F.broadcast(totals), "check", "left").withColumn("anomalies", F.coalesce("anomalies", F.lit(0)).cast("long"))


def warnings_of(totals: DataFrame) -> DataFrame:
    """(check, anomalies, warning) for each check that found something."""
    return totals.where("anomalies > 0").withColumn("warning", F.format_string(WARNING, F.col("check"), F.col("anomalies")))
