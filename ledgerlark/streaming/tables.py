"""Results of streams that change until the watermark has passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.operators.newest import upsert
from ledgerlark.session import located, scratch_scope, written
from ledgerlark.sources.lake import names_in


class ReplacingTable:
    """A parquet folder in which a stream's rows take the place of those with the same keys.

    A row has ``day``, its partition, and ``last_at``, the newest event in it. Each micro-batch rewrites the
    days that it has rows of. How far the stream has come is kept beside the rows, so that a reader can tell
    the final ones without any row being written again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys

    def _rows(self) -> DataFrame:
        files, folder = located(self.spark, f"{self.path}/rows")
        files.mkdirs(folder)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def take(self, batch: DataFrame, number: int) -> None:
        """Take in a micro-batch; the same one again changes nothing."""
        with scratch_scope(self.spark):
            newest = Observation()
            batch = batch.select(*self.schema.fieldNames()).observe(newest, F.max(F.unix_micros("last_at")).alias("reached"))
            incoming = written(batch, "stream-rows")  # a stateful plan runs once
            days = [r.day for r in incoming.select("day").distinct().collect()]
            if not days:
                return
            stored = self._rows().where(F.col("day").isin(days))
            merged = incoming.hint("rebalance", "day")
            if not stored.isEmpty():
                # No job reads what it overwrites: the new days are put together elsewhere first.
                merged = upsert(stored, incoming, ["day", *self.keys]).hint("rebalance", "day")
                merged = written(merged, "stream-merged", "day")
            (
                merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("day").parquet(f"{self.path}/rows")
            )
            files, mark = located(self.spark, f"{self.path}/reached/at={newest.get['reached']}")
            files.mkdirs(mark)

    def read(self, ends_at: str, delay: str) -> DataFrame:
        """The rows, ``is_final`` where ``ends_at``, an instant, is behind the newest event by ``delay``."""
        reached = max(map(int, names_in(self.spark, f"{self.path}/reached", "at=")), default=None)
        watermark = F.timestamp_micros(F.lit(reached).cast("long")) - F.expr(f"INTERVAL {delay}")
        final = F.coalesce(F.expr(ends_at) <= watermark, F.lit(False))
        return self._rows().withColumn("is_final", final).drop("day", "last_at")


def keep_current(rows: DataFrame, table: ReplacingTable, checkpoint: str) -> StreamingQuery:
    """Run a stream in update mode into the table until its source is used up."""
    return (
        rows.writeStream.outputMode("update")
        .foreachBatch(table.take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
