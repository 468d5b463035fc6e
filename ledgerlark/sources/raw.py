"""Raw files and records into Bronze: strings as they come, duplicates and nulls kept."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.schemas import BRONZE, RAW_TABLES
from ledgerlark.session import scratch_scope
from ledgerlark.sources.lake import Lake, path_exists
from ledgerlark.sources.stitched import stitched_csv, stitched_json

log = logging.getLogger(__name__)


def delimiter_of(header: str, columns: int) -> str:
    """The usual delimiter that cuts the header into as many parts as the table has columns."""
    for candidate in (",", ";", "\t", "|"):
        if len(header.split(candidate)) == columns:
            return candidate
    return ","


def csv_options(spark: SparkSession, path: str, table: str, multi_line: bool) -> dict[str, object]:
    """How CSV files at ``path`` are read, in batch and on a stream; a row that has too few or
    too many columns fails the read."""
    header = spark.read.text(path).head() if path_exists(spark, path) else None
    return {
        "header": True,
        "enforceSchema": True,
        "sep": delimiter_of(header[0] if header else "", len(BRONZE[table])),
        "escape": '"',
        "multiLine": multi_line,
        "mode": "FAILFAST",
    }


def read_csv(
    spark: SparkSession, path: str, table: str, multi_line: bool = False
) -> DataFrame:
    """A CSV file, or a folder of them, with headers; columns bind by position.

    Files are split over tasks. Set ``multi_line`` when quoted values may hold line breaks: the lines of
    a record are then put together first.
    """
    options = csv_options(spark, path, table, multi_line)
    if multi_line:
        return stitched_csv(spark, path, BRONZE[table], options["sep"])
    return spark.read.schema(BRONZE[table]).options(**options).csv(path)


def json_records(reader, path: str, table: str, form: str) -> DataFrame:
    """Records of a batch or stream reader; text that is not in the given form fails the read.

    ``lines``: one record per line, files are split over tasks. ``array``: each file is one
    array of records, read by one task on a stream; in batch see ``read_json``.
    """
    schema = BRONZE[table]
    if form == "lines":
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    if form != "array":
        raise ValueError(f"unknown JSON form: {form}")
    files = reader.text(path, wholetext=True)
    text = F.regexp_replace("value", r"^[\s\uFEFF]+|\s+$", "")
    whole = F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]"))
    checked = F.when(whole, text).otherwise(
        F.raise_error(F.lit("a JSON file is not an array of records")).cast("string")
    )
    records = F.from_json(checked, T.ArrayType(schema), {"mode": "FAILFAST"})
    return files.select(F.explode(records).alias("r")).select("r.*")


def read_json(spark: SparkSession, path: str, table: str, form: str = "array") -> DataFrame:
    """A JSON file, or a folder of them, read by many tasks. Columns bind by name, missing ones are NULL."""
    if form == "array":
        return stitched_json(spark, path, BRONZE[table])
    return json_records(spark.read, path, table, form)


def from_records(
    spark: SparkSession, records: Sequence[Mapping[str, object]], table: str
) -> DataFrame:
    """Records held in memory; values become strings, missing keys NULL."""
    names = BRONZE[table].fieldNames()
    rows = [
        tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in records
    ]
    return spark.createDataFrame(rows, BRONZE[table])


def source_for(
    spark: SparkSession, folder: str, table: str, multi_line: bool = False, json_form: str = "array"
) -> DataFrame | None:
    """The table's file in a folder: JSON wins over CSV, None without either."""
    if path_exists(spark, f"{folder}/{table}.json"):
        return read_json(spark, f"{folder}/{table}.json", table, json_form)
    if path_exists(spark, f"{folder}/{table}.csv"):
        return read_csv(spark, f"{folder}/{table}.csv", table, multi_line)
    log.warning("No source files found for table: %s", table)
    return None


def load_bronze(
    lake: Lake,
    source: str | Mapping[str, Sequence[Mapping[str, object]] | DataFrame],
    multi_line: bool = False,
    json_form: str = "array",
) -> dict[str, int]:
    """Append a folder of files, or a mapping of records or frames, to Bronze.

    ``multi_line`` reads CSV values with line breaks, ``json_form`` is ``array`` or ``lines``.
    Returns the rows added per table, counted while they are written.
    """
    with scratch_scope(lake.spark):
        return _load(lake, source, multi_line, json_form)


def _load(lake, source, multi_line, json_form) -> dict[str, int]:
    spark = lake.spark
    if isinstance(source, str):
        if not path_exists(spark, source):
            raise ValueError(f"not a folder: {source}")
        frames = {t: source_for(spark, source, t, multi_line, json_form) for t in RAW_TABLES}
    elif isinstance(source, Mapping):
        frames = {}
        for t in RAW_TABLES:
            given = source.get(t, [])
            frames[t] = given if isinstance(given, DataFrame) else from_records(spark, given, t)
    else:
        raise ValueError("source must be a folder or a mapping of table names to records")
    return {t: 0 if df is None else _append_counted(lake, t, df) for t, df in frames.items()}


def _append_counted(lake: Lake, table: str, df: DataFrame) -> int:
    added = Observation()
    counted = df.observe(added, F.count(F.lit(1)).alias("rows"))
    lake.add_load(table, counted, uuid.uuid4().hex)
    return added.get["rows"]
