"""The layered tables as parquet folders, with replace-by-key on plain files.

Bronze has one folder per load, so a repeated load replaces itself. Silver is partitioned by a hash bucket of its key and Gold by observation date, so an
upsert rewrites only the partitions its rows fall into. New partition contents are first
written to the shared scratch folder and then swapped in by dynamic partition overwrite: no
job reads what it overwrites, and a run that dies half-way is repeated without harm.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark import schemas
from ledgerlark.operators.newest import newest_per_key, upsert
from ledgerlark.session import located, scratch_path, scratch_scope, written

# Ids of the logs with the day they were logged on, in hash buckets of the id.
LOG_KEYS = ("prediction_log_keys", "dialogue_log_keys")

# Silver tables that features of days are made of, with the day of a row. Their files are in this order.
DAY_TABLES = {
    "loans": "disbursement_date",
    "user_sessions": "CAST(session_timestamp AS DATE)",
}

# Tables with a folder per run, so a repeated run replaces itself.
BY_RUN = {("gold", "run_metrics"): schemas.RUN_METRICS}


def _dated(schema: T.StructType, column: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(column, T.DateType())])


# Tables partitioned by a date: schema and partition column.
DATED = {
    ("gold", "target_construction"): (schemas.GOLD_TARGET, "observation_date"),
    ("gold", "prediction_logs"): (_dated(schemas.PREDICTION_LOGS, "log_date"), "log_date"),
    ("gold", "dialogue_logs"): (_dated(schemas.DIALOGUE_LOGS, "log_date"), "log_date"),
    ("gold", "drift_metrics"): (_dated(schemas.DRIFT_METRICS, "metric_date"), "metric_date"),
    ("gold", "daily_sketches"): (_dated(schemas.DAILY_SKETCHES, "log_date"), "log_date"),
    ("gold", "daily_activity"): (_dated(schemas.DAILY_ACTIVITY, "day"), "day"),
}


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = located(spark, path)
    return files.exists(target)


def names_in(spark: SparkSession, path: str, prefix: str) -> set[str]:
    """What follows ``prefix`` in the names of the folders at ``path``."""
    files, folder = located(spark, path)
    if not files.exists(folder):
        return set()
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return {n.removeprefix(prefix) for n in names if n.startswith(prefix)}


class Lake:
    """Tables under one root folder.

    ``buckets`` is the number of hash partitions of each Silver table. Pick it once per
    lake so that one bucket is a comfortable rewrite (thousands at 100 TB).
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # -- layout ---------------------------------------------------------------------
    def path(self, layer: str, table: str) -> str:
        if layer == "silver" or table in LOG_KEYS:
            return f"{self.root}/{layer}/{table}/of={self.buckets}"
        return f"{self.root}/{layer}/{table}"

    def schema(self, layer: str, table: str) -> T.StructType:
        if layer == "bronze":
            return T.StructType(
                [*schemas.BRONZE[table].fields, T.StructField("load", T.StringType())]
            )
        if layer == "silver":
            return T.StructType(
                [*schemas.SILVER[table].fields, T.StructField("bucket", T.IntegerType())]
            )
        if table in LOG_KEYS:
            return schemas.LOG_KEYS
        if (layer, table) in DATED:
            return DATED[(layer, table)][0]
        return BY_RUN[(layer, table)]

    def partition(self, layer: str, table: str) -> str | None:
        """The partition column of a table."""
        by_layer = {"bronze": "load", "silver": "bucket"}
        if (layer, table) in BY_RUN:
            return "run_id"
        if table in LOG_KEYS:
            return "bucket"
        return by_layer.get(layer) or DATED.get((layer, table), (None, None))[1]

    def tables(self) -> list[tuple[str, str]]:
        raw = [(layer, t) for layer in ("bronze", "silver") for t in schemas.RAW_TABLES]
        return [*raw, *DATED, *BY_RUN, *[("gold", t) for t in LOG_KEYS]]

    def create(self) -> None:
        """Create every missing table, empty; existing ones stay as they are.

        Schemas are fixed in code, so an empty folder is an empty table.
        """
        for layer, table in self.tables():
            self._refuse_other_bucketing(layer, table)
            files, folder = located(self.spark, self.path(layer, table))
            files.mkdirs(folder)

    def _refuse_other_bucketing(self, layer: str, table: str) -> None:
        folder = f"{self.root}/{layer}/{table}"
        if (layer == "silver" or table in LOG_KEYS) and path_exists(self.spark, folder):
            if not path_exists(self.spark, self.path(layer, table)):
                raise ValueError(f"{folder} was created with another number of buckets")

    # -- reading --------------------------------------------------------------------
    def _stored(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.schema(self.schema(layer, table)).parquet(self.path(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        df = self._stored(layer, table)
        return df.drop("load", "bucket") if layer in ("bronze", "silver") else df

    def read_loads(self, table: str, loads: Iterable[str], with_load: bool = False) -> DataFrame:
        """The given loads of a Bronze table; the folders of others are not read."""
        rows = self._stored("bronze", table).where(F.col("load").isin(sorted(loads)))
        return rows if with_load else rows.drop("load")

    def layer(self, layer: str) -> dict[str, DataFrame]:
        return {t: self.read(layer, t) for t in schemas.RAW_TABLES}

    def register_views(self) -> None:
        """A temporary view ``<layer>_<table>`` for each table, for use from SQL."""
        for layer, table in self.tables():
            self.read(layer, table).createOrReplaceTempView(f"{layer}_{table}")

    def row_counts(self, layers: Iterable[str] = ("bronze", "silver")) -> DataFrame:
        """(layer, table, rows)."""
        counts = None
        for layer, table in self.tables():
            if layer not in layers:
                continue
            one = self.read(layer, table).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(layer).alias("layer"), F.lit(table).alias("table"), "rows"
            )
            counts = one if counts is None else counts.unionByName(one)
        return counts

    # -- writing --------------------------------------------------------------------
    def add_load(self, table: str, df: DataFrame, load: str) -> None:
        """Write one load into Bronze; the same load id again replaces it."""
        rows = df.select(*schemas.BRONZE[table].fieldNames())
        rows.write.mode("overwrite").parquet(f"{self.path('bronze', table)}/load={load}")

    def loads(self, table: str) -> set[str]:
        """Names of the loads in Bronze, from its folders."""
        return names_in(self.spark, self.path("bronze", table), "load=")

    def merged_loads(self, table: str) -> set[str]:
        """Loads that Silver has taken in."""
        return names_in(self.spark, f"{self.root}/merged/{table}", "load=")

    def mark_merged(self, table: str, loads: Iterable[str]) -> None:
        self._mark(f"{self.root}/merged/{table}", "load=", loads)

    def _mark(self, folder: str, prefix: str, names: Iterable[object]) -> None:
        for name in names:
            files, mark = located(self.spark, f"{folder}/{prefix}{name}")
            files.mkdirs(mark)

    def _delete(self, path: str) -> None:
        files, target = located(self.spark, path)
        files.delete(target, True)

    # -- counts of loads (plans.quality) ------------------------------------------------
    def audited_loads(self, table: str) -> set[str]:
        """Loads whose quality counts are stored."""
        return names_in(self.spark, f"{self.root}/quality/counts/table_name={table}", "load=")

    def audit_counts(self) -> DataFrame:
        """(table_name, load, check, anomalies) of every counted load."""
        files, folder = located(self.spark, f"{self.root}/quality/counts")
        files.mkdirs(folder)
        return self.spark.read.schema(schemas.AUDIT_COUNTS).parquet(f"{self.root}/quality/counts")

    def replace_audit_counts(self, counts: DataFrame) -> None:
        columns = [f.name for f in schemas.AUDIT_COUNTS.fields]
        (
            counts.select(*columns).coalesce(1).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("table_name", "load")
            .parquet(f"{self.root}/quality/counts")
        )

    def _audit_keys_path(self, table: str) -> str:
        return f"{self.root}/quality/keys/{table}/of={self.buckets}"

    def audit_keys(self, table: str) -> DataFrame:
        """(id, load, bucket): every key that a counted load has had, with the first such load."""
        files, folder = located(self.spark, self._audit_keys_path(table))
        files.mkdirs(folder)
        return self.spark.read.schema(schemas.AUDIT_KEYS).parquet(self._audit_keys_path(table))

    def append_audit_keys(self, table: str, rows: DataFrame) -> None:
        writer = rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket")
        writer.parquet(self._audit_keys_path(table))

    # -- days that merges have changed (plans.daily) --------------------------------------
    def changes(self, table: str) -> set[str]:
        return names_in(self.spark, f"{self.root}/changes/{table}", "change=")

    def changed_days(self, table: str, changes: Iterable[str]) -> list[dt.date]:
        paths = [f"{self.root}/changes/{table}/change={c}" for c in sorted(changes)]
        rows = self.spark.read.schema("day date").parquet(*paths).where("day IS NOT NULL").distinct()
        return [r.day for r in rows.collect()]  # one for each day of the calendar at most

    def _note_days(self, table: str, *rows: DataFrame) -> None:
        """Keep the days of rows that a merge is about to bring or to replace."""
        days = None
        for df in rows:
            own = df.select(F.expr(DAY_TABLES[table]).alias("day")).distinct()
            days = own if days is None else days.unionByName(own).distinct()
        days.coalesce(1).write.parquet(f"{self.root}/changes/{table}/change={uuid.uuid4().hex}")

    def seen_changes(self, table: str) -> set[str]:
        """Changes that the rows of days have taken in."""
        return names_in(self.spark, f"{self.root}/seen/{table}", "change=")

    def see_changes(self, table: str, changes: Iterable[str]) -> None:
        self._mark(f"{self.root}/seen/{table}", "change=", changes)

    def marked_days(self) -> set[dt.date]:
        """Days whose rows are up to date but for changes not seen."""
        return {dt.date.fromisoformat(d) for d in names_in(self.spark, f"{self.root}/days", "day=")}

    def mark_days(self, days: Iterable[dt.date]) -> None:
        self._mark(f"{self.root}/days", "day=", days)

    def unmark_days(self, days: Iterable[dt.date]) -> None:
        for d in self.marked_days().intersection(days):
            self._delete(f"{self.root}/days/day={d}")

    def replace_days(self, rows: DataFrame, days: Iterable[dt.date]) -> None:
        """Store the rows of the given days, which may have none, in place of what they had."""
        for d in days:
            self._delete(f"{self.path('gold', 'daily_activity')}/day={d}")
        columns = self.schema("gold", "daily_activity").fieldNames()
        self._swap("gold", "daily_activity", rows.select(*columns).hint("rebalance", "day"), "day")

    def append(self, layer: str, table: str, df: DataFrame) -> None:
        columns = self.schema(layer, table).fieldNames()
        writer = df.select(*columns).write.mode("append")
        if partition := self.partition(layer, table):
            writer = writer.partitionBy(partition)
        writer.parquet(self.path(layer, table))

    def _swap(self, layer: str, table: str, df: DataFrame, partition: str) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(self.path(layer, table))
        )

    def bucketed(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with the hash bucket of its key."""
        return df.withColumn(
            "bucket", F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        )

    def compact(self, layer: str, table: str, most_files: int) -> list[str]:
        """Rewrite the partitions that have more files than that; returns their folders' names.

        Small appends leave small files. Contents stay as they are; nothing else may write the
        table meanwhile.
        """
        files, folder = located(self.spark, self.path(layer, table))
        partition = self.partition(layer, table)
        full = []
        for status in files.listStatus(folder) if files.exists(folder) else ():
            name = status.getPath().getName()
            if name.startswith(f"{partition}="):
                parts = [f for f in files.listStatus(status.getPath()) if f.getPath().getName().startswith("part-")]
                if len(parts) > most_files:
                    full.append(name)
        if full:
            values = [name.removeprefix(f"{partition}=") for name in full]
            rows = self._stored(layer, table).where(F.col(partition).cast("string").isin(values))
            with scratch_scope(self.spark):
                packed = written(rows.hint("rebalance", partition), f"compact-{table}", partition)
                self._swap(layer, table, packed, partition)
        return sorted(full)

    def stage_silver(
        self, table: str, incoming: DataFrame, keep_newer: bool = False
    ) -> tuple[DataFrame, str | None]:
        """The new contents of the buckets ``incoming`` touches, written to scratch, and their folder if
        these buckets have no rows yet: it can be moved in as it is.

        ``incoming`` holds each key once; its rows replace stored ones, the other rows of
        the bucket stay. With ``keep_newer`` a stored row that is newer than the incoming
        one stays too: needed when ``incoming`` is not the whole of Bronze.
        """
        rows = self.bucketed(incoming, schemas.SILVER_RULES[table].key).hint("rebalance", "bucket")
        folder = scratch_path(self.spark, f"incoming-{table}")
        batch = written(self._by_day(table, rows), f"incoming-{table}", "bucket", folder)
        touched = [r.bucket for r in batch.select("bucket").distinct().collect()]
        stored = self._stored("silver", table).where(F.col("bucket").isin(touched))
        rule = schemas.SILVER_RULES[table]
        fresh = stored.isEmpty()
        if table in DAY_TABLES:
            replaced = [] if fresh else [stored.join(batch.select("bucket", rule.key), ["bucket", rule.key], "left_semi")]
            self._note_days(table, batch, *replaced)
        if fresh:
            return batch, folder
        if keep_newer:
            merged = newest_per_key(
                stored.select(*batch.columns).unionByName(batch), rule.key, rule.newest
            )
        else:
            merged = upsert(stored, batch, ["bucket", rule.key])
        return written(merged.hint("rebalance", "bucket"), f"silver-{table}", "bucket"), None

    def _by_day(self, table: str, rows: DataFrame) -> DataFrame:
        """Files of tables that are read by day are in order of days."""
        if table not in DAY_TABLES:
            return rows
        return rows.sortWithinPartitions("bucket", F.expr(DAY_TABLES[table]))

    def publish_silver(self, table: str, staged: DataFrame, folder: str | None = None) -> None:
        """Swap staged buckets in. Staged files hold one bucket each, so this is a plain
        copy without a shuffle; buckets that are new are moved."""
        if not folder or not self._moved_in("silver", table, folder, "bucket"):
            self._swap("silver", table, self._by_day(table, staged), "bucket")

    def _moved_in(self, layer: str, table: str, folder: str, partition: str) -> bool:
        """Move the partitions of a scratch folder into a table. Nothing is moved if it has a folder for one
        of them or is on another file system."""
        path = self.path(layer, table)
        files, _ = located(self.spark, folder)
        own, _ = located(self.spark, path)
        names = names_in(self.spark, folder, f"{partition}=")
        if files.getUri().toString() != own.getUri().toString() or names & names_in(self.spark, path, f"{partition}="):
            return False
        for name in sorted(names):
            _, source = located(self.spark, f"{folder}/{partition}={name}")
            _, target = located(self.spark, f"{path}/{partition}={name}")
            if not files.rename(source, target):
                raise OSError(f"{folder}/{partition}={name} could not be moved to {path}")
        return True

    def upsert_silver(
        self, batches: dict[str, DataFrame], keep_newer: bool = False
    ) -> None:
        """Replace-by-key into several Silver tables.

        All of them are computed and written to scratch before the first one is swapped in,
        so a failure in any computation leaves every table as it was.
        """
        with scratch_scope(self.spark):
            staged = {t: self.stage_silver(t, df, keep_newer) for t, df in batches.items()}
            for table, (df, folder) in staged.items():
                self.publish_silver(table, df, folder)

    def merge_gold(self, incoming: DataFrame, observation_date: str | dt.date) -> int:
        """Replace-by-key into one date of the Gold target table; returns the incoming rows.

        ``incoming`` holds each user once, for that date. Only that date is rewritten: its
        merged rows are computed and written once, then swapped in by a copy.
        """
        with scratch_scope(self.spark):
            return self._merge_gold(incoming, observation_date)

    def _merge_gold(self, incoming: DataFrame, observation_date: str | dt.date) -> int:
        layer, table = "gold", "target_construction"
        fields = schemas.GOLD_TARGET.fields
        date = F.lit(str(observation_date)).cast("date")
        wrong = F.raise_error(F.lit(f"a row is not of {observation_date}")).cast("date")
        batch = incoming.withColumn(
            "observation_date", F.when(F.col("observation_date") == date, date).otherwise(wrong)
        ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        added = Observation()
        batch = batch.observe(added, F.count(F.lit(1)).alias("rows"))
        stored = self._stored(layer, table).where(F.col("observation_date") == date)
        row = F.struct(F.col("_new"), *[F.col(f.name) for f in fields])
        merged = (
            batch.withColumn("_new", F.lit(1))
            .unionByName(stored.withColumn("_new", F.lit(0)))
            .groupBy(F.col("user_id").alias("_user"))
            .agg(F.max(row).alias("r"))
            .select(*[f"r.{f.name}" for f in fields])
        )
        self._swap(layer, table, written(merged, "gold"), "observation_date")
        return added.get["rows"]

    def replace_drift_metrics(self, metrics: DataFrame) -> None:
        """Replace the stored metrics of the days in ``metrics`` (seven rows per day)."""
        columns = self.schema("gold", "drift_metrics").fieldNames()
        dated = metrics.withColumn("metric_date", F.to_date("timestamp")).select(*columns)
        self._swap("gold", "drift_metrics", dated.coalesce(1), "metric_date")

    def replace_sketches(self, rows: DataFrame) -> None:
        """Store the sketches of the days in ``rows`` (a few per day) in place of what they had."""
        columns = self.schema("gold", "daily_sketches").fieldNames()
        self._swap("gold", "daily_sketches", rows.select(*columns).hint("rebalance", "log_date"), "log_date")

    def replace_run(self, rows: DataFrame) -> None:
        """Store the rows of a run (a handful) in place of those under the same id."""
        columns = self.schema("gold", "run_metrics").fieldNames()
        self._swap("gold", "run_metrics", rows.select(*columns).coalesce(1), "run_id")
