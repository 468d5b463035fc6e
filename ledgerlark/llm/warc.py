"""WARC records in a content-addressed archive.

Payload bytes are stored once under their SHA-256, record headers separately and exactly; a record is
put together again by a join on the digest, after the stored bytes were checked against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import written

REVISIT_MIN_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORD_ID = "urn:page:"


def crlf(*lines: Column) -> Column:
    """Header lines, null ones left out, with the empty line that ends a header."""
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


#: Characters that cannot stand in a header line.
CONTROLS = [chr(c) for c in (*range(32), 127)]
UNSAFE = r"[\x00-\x1F\x7F]"


def escaped(value: Column) -> Column:
    """Control characters, and percent signs before them, as percent and two hex digits; back by ``unescaped``."""
    out = F.replace(value, F.lit("%"), F.lit("%25"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def unescaped(value: Column) -> Column:
    """Every percent sign of the text stands for an escape, so the order does not matter but for its own."""
    for c in CONTROLS:
        value = F.replace(value, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return F.replace(value, F.lit("%25"), F.lit("%"))


def line(name: str, value: Column) -> Column:
    """One header line; a null value gives none."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def uri_lines(url: Column) -> list[Column]:
    """The address as it is; one with control characters is escaped, and a line more says so."""
    unsafe = url.rlike(UNSAFE)
    return [
        line("WARC-Target-URI", F.when(unsafe, escaped(url)).otherwise(url)),
        F.when(unsafe, F.lit("X-Target-URI-Escaped: yes")),
    ]


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> None:
    """Write ``path``/payloads and ``path``/headers; one record for each row of ``pages``.

    A null payload is empty. Among equal payloads of at least 1000 bytes the row with the largest id is
    the response, the others are revisits of it; rows that share that id are all responses, and so are
    rows whose group has no id at all. A row without an id in a group with one is a revisit.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    light = rows.select(
        "page_id", "url", "digest",
        F.sha1("payload").alias("sha1"),
        F.length("payload").cast("long").alias("payload_bytes"),
    )
    # Hot payloads are combined before the shuffle: one row per task and digest.
    # Written, so that the join has a shuffle of its own on either side and a hot payload can be split.
    groups = written(light.groupBy("digest").agg(F.max("page_id").alias("newest")), "warc-groups")
    http = crlf(
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        line("Content-Length", F.col("payload_bytes")),
    )
    revisit = (F.col("payload_bytes") >= REVISIT_MIN_BYTES) & ~F.col("page_id").eqNullSafe(F.col("newest"))
    warc = crlf(
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit(f"WARC-Record-ID: <{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")),
        *uri_lines(F.col("url")),
        F.lit(f"WARC-Date: {DATE}"),
        F.lit("Content-Type: application/http;msgtype=response"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{RECORD_ID}"), F.col("newest"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        line(
            "Content-Length",
            F.length(F.encode("http", "UTF-8")) + F.when(revisit, 0).otherwise(F.col("payload_bytes")),
        ),
    )
    (
        light.join(groups, "digest")
        .withColumn("http", http)
        .select("page_id", "digest", F.encode(F.concat(warc, "http"), "UTF-8").alias("header"))
        .write.parquet(f"{path}/headers")
    )
    (
        rows.groupBy("digest").agg(F.first("payload").alias("payload"))
        .write.parquet(f"{path}/payloads")
    )


def checked(payload: Column, digest: Column) -> Column:
    """The payload, or an error when its bytes do not have the digest they are stored under."""
    return F.when(F.unhex(F.sha2(payload, 256)) == digest, payload).otherwise(
        F.raise_error(F.lit("a stored payload does not have its digest"))
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record, put together and parsed: fields, exact header, payload of the original record."""
    payloads = spark.read.parquet(f"{path}/payloads")
    payloads = payloads.select("digest", checked(F.col("payload"), F.col("digest")).alias("payload"))
    # Left: a record whose payload is missing must not vanish.
    joined = spark.read.parquet(f"{path}/headers").join(payloads, "digest", "left")
    head = F.decode("header", "UTF-8")
    joined = joined.withColumn("head", head).withColumn(
        "payload",
        F.coalesce("payload", F.raise_error(F.lit("a record's payload is missing")).cast("binary")),
    )

    # Lines end in the two characters of the format only: others may stand in an address.
    def field(name: str, pattern: str) -> Column:
        whole = rf"(?md)^{name}: {pattern}\r$"
        return F.when(F.rlike("head", F.lit(whole)), F.regexp_extract("head", whole, 1))

    url = field("WARC-Target-URI", r"(.*?)")

    parsed = joined.select(
        "page_id", "header", "payload",
        field("WARC-Type", r"(\w+)").alias("record_type"),
        F.when(field("X-Target-URI-Escaped", r"(yes)").isNotNull(), unescaped(url)).otherwise(url).alias("url"),
        field("WARC-Refers-To", rf"<{RECORD_ID}(-?\d+)>").cast("long").alias("refers_to"),
        field("WARC-Payload-Digest", r"sha1:([0-9a-f]{40})").alias("payload_digest"),
    )
    same = F.sha1("payload") == F.col("payload_digest")
    return parsed.withColumn(
        "payload_digest",
        F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload differs from its record"))),
    )


def record_bytes() -> Column:
    """The record as it stands in a WARC file, from a row of ``read_archive``."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.col("header"), body, F.lit(b"\r\n\r\n"))


def original_bytes() -> Column:
    """The full original record of every row, revisits too: header and payload."""
    return F.concat(F.col("header"), F.col("payload"), F.lit(b"\r\n\r\n"))
