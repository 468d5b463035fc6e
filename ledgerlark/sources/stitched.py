"""Large files whose records have no fixed end, read by many tasks: CSV with line breaks in quotes, JSON arrays.

Spark cuts a file into byte ranges and those into pieces at one character, the line break or the closing
brace. Whether that character ended a record depends on all quotes and braces before it: they are counted in
every range side by side, a running sum over the ranges tells each one what it starts in, and pieces of one
record are put together and parsed by Spark. One range is the largest unit of a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.session import written


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, at, value): what stands between the separators, in order of the last two."""
    meta = F.col("_metadata")
    rows = spark.read.text(path, lineSep=separator).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    return written(rows, "pieces")  # the numbers stay as they are


def running(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all earlier pieces of the file."""
    rows = rows.withColumn("_v", value.cast("long"))
    blocks = rows.groupBy("file", "block").agg(F.sum("_v").alias("_sum"))
    over_blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", F.coalesce(F.sum("_sum").over(over_blocks), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    added = rows.join(starts, ["file", "block"]).withColumn(name, F.col("_start") + F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return added.drop("_v", "_start")


def count_of(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def records(rows: DataFrame, ends: Column, separator: str) -> DataFrame:
    """(file, record, text): the pieces up to one that ``ends`` a record, with the separators between them."""
    numbered = running(rows, "record", ends.cast("int"))
    own = F.sort_array(F.collect_list(F.struct("block", "at", "value")))["value"]
    return numbered.groupBy("file", "record").agg(F.array_join(own, separator).alias("text"))


def failed(message: str, kind: str = "string") -> Column:
    return F.raise_error(F.lit(message)).cast(kind)


def stitched_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    """CSV with one header record per file and any line break inside quotes; a quote in quotes is doubled.

    Bad rows fail the read, and so does a quote that is never closed.
    """
    lines = pieces(spark, path, "\n")
    quotes = count_of(F.col("value"), '"')
    seen = running(lines, "quotes", quotes)
    whole = records(seen, (F.col("quotes") + quotes) % 2 == 0, "\n")
    text = F.regexp_replace("text", r"\r\z", "")
    body = whole.where("record > 0").select(text.alias("text")).where(~F.rlike("text", F.lit(r"\A\s*\z")))
    closed = F.when(count_of(F.col("text"), '"') % 2 == 0, F.col("text")).otherwise(failed("a quote in a CSV file is not closed"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(closed, columns, {"sep": sep, "escape": '"', "mode": "FAILFAST"})
    return body.select(parsed.alias("r")).select("r.*")


#: JSON text without its escapes, and the strings in what is left.
ESCAPES, STRINGS = r"(?s)\\.", r'"[^"]*("|\z)'


def stitched_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that each hold one JSON array of records. Text of any other form fails the read."""
    cut = pieces(spark, path, "}")
    last = cut.groupBy("file").agg(F.max(F.struct("block", "at")).alias("last"))
    rows = cut.join(last, "file").withColumn("closed", F.struct("block", "at") != F.col("last")).drop("last")
    plain = F.regexp_replace("value", ESCAPES, "")
    quotes = count_of(plain, '"')
    rows = running(rows, "quotes", quotes)
    inside = F.col("quotes") % 2 == 1
    outside = F.regexp_replace(F.when(inside, F.regexp_replace(plain, r'\A[^"]*("|\z)', "")).otherwise(plain), STRINGS, "")
    closes = F.col("closed") & ((F.col("quotes") + quotes) % 2 == 0)
    step = count_of(outside, "{") - closes.cast("int")
    rows = running(rows.withColumns({"step": step, "closes": closes}), "depth", F.col("step"))
    whole = records(rows, F.col("closes") & (F.col("depth") + F.col("step") == 0), "}")
    # The last group of a file is what stands behind its last record.
    ends = whole.groupBy("file").agg(F.max("record").alias("rest"))
    whole = whole.join(ends, "file")
    first = r"\A[\s\uFEFF]*\[\s*"
    begins = F.when(F.col("record") == 0, F.rlike("text", F.lit(first + r"\{"))).otherwise(F.rlike("text", F.lit(r"\A\s*,\s*\{")))
    tail = F.when(F.col("record") == 0, F.rlike("text", F.lit(first + r"\]\s*\z"))).otherwise(F.rlike("text", F.lit(r"\A\s*\]\s*\z")))
    fits = F.when(F.col("record") == F.col("rest"), tail).otherwise(begins)
    text = F.when(fits, F.concat(F.regexp_replace("text", r"\A[\s\uFEFF]*[\[,]\s*", ""), F.lit("}"))).otherwise(
        failed("a JSON file is not an array of records")
    )
    checked = whole.withColumn("text", text).where((F.col("record") < F.col("rest")) | F.col("text").isNull())
    return checked.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
