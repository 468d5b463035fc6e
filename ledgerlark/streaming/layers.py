"""Raw files to Bronze and Bronze to Silver, as streams."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.plans.silver import to_silver
from ledgerlark.schemas import BRONZE
from ledgerlark.sources.lake import Lake
from ledgerlark.sources.raw import csv_options, json_records


def stream_to_bronze(
    lake: Lake,
    table: str,
    folder: str,
    checkpoint: str,
    file_format: str = "csv",
    multi_line: bool = False,
    json_form: str = "lines",
) -> StreamingQuery:
    """Load the files that arrive in ``folder``; stops when all present ones are loaded.

    Each micro-batch is its own Bronze load, named by the id that the checkpoint keeps for
    the query and its batch number: repeated after a failure it replaces itself, and no other
    stream shares its names. The delimiter is read from the files present at the start.
    """
    reader = lake.spark.readStream
    if file_format == "csv":
        options = csv_options(lake.spark, folder, table, multi_line)
        files = reader.schema(BRONZE[table]).options(**options).csv(folder)
    else:
        files = json_records(reader, folder, table, json_form)

    def add(batch: DataFrame, number: int) -> None:
        kept = lake.spark.read.text(f"{checkpoint}/metadata").head()[0]
        lake.add_load(table, batch, f"stream-{json.loads(kept)['id']}-{number}")

    return (
        files.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_to_silver(lake: Lake, table: str, checkpoint: str) -> StreamingQuery:
    """Clean each new part of Bronze and merge it into Silver by key.

    A micro-batch is only a part of Bronze, so a row already in Silver that is newer than the
    incoming one stays. Repeating a batch changes nothing.
    """
    added = lake.spark.readStream.schema(lake.schema("bronze", table)).parquet(
        lake.path("bronze", table)
    )

    def merge(batch: DataFrame, number: int) -> None:
        lake.upsert_silver({table: to_silver(batch.drop("load"), table)}, keep_newer=True)

    return (
        added.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
