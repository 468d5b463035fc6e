"""Document fingerprints: one-permutation MinHash with optimal densification, in DataFrame functions only.

Each shingle is hashed once. The top bits of the hash choose one of BINS bins, a bin holds its smallest
hash. An empty bin borrows from the first filled bin of its own fixed random order, so equal sets borrow
alike. The low BITS bits of each bin are kept, and the share of equal bins is corrected for the matches
that so few bits give by chance.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import written

SHINGLE = 5
BINS = 128
BITS = 8
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Bits below the bin number.
LOW = 64 - BINS.bit_length() + 1


def constants(values: list[int], kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def sentinels() -> list[int]:
    """For each bin the largest hash, which stands for an empty bin; signed order."""
    top = [(b << LOW) | ((1 << LOW) - 1) for b in range(BINS)]
    return [v - (1 << 64) if v >> 63 else v for v in top]


def is_empty(value: Column) -> Column:
    return value.bitwiseAND(F.lit((1 << LOW) - 1)) == (1 << LOW) - 1


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of a text column; no words: the empty string.

    Shingles are SHINGLE consecutive words, or all words of a shorter text.
    """
    draw = random.Random(BINS)
    shifts = constants([draw.randrange(BINS) for _ in range(BINS)], "int")
    steps = constants([draw.randrange(1, BINS, 2) for _ in range(BINS)], "int")
    own = [f"`{c}`" for c in rows.columns]
    hashes = F.transform(F.filter(F.split(text, WORD_BREAK), lambda w: w != ""), lambda w: F.xxhash64(w))
    rows = rows.select(*own, hashes.alias("__w"))
    w = F.col("__w")
    shingles = F.when(
        F.size(w) >= SHINGLE,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]),
        ),
    ).when(F.size(w) > 0, F.array(F.xxhash64(w)))
    rows = rows.select(*own, F.sort_array(F.concat(shingles, constants(sentinels(), "bigint"))).alias("__s"))
    s = F.col("__s")
    first = F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, LOW) != F.shiftright(F.get(s, i - 1), LOW)))
    rows = rows.select(*own, first.alias("__d"))
    d = F.col("__d")
    filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: ~is_empty(F.get(d, j)))
    rows = rows.select(*own, "__d", F.when(d.isNotNull(), filled).alias("__f"))

    def borrowed(j: Column) -> Column:
        place = lambda b: ((b + F.get(shifts, j)) * F.get(steps, j)).bitwiseAND(F.lit(BINS - 1)) * BINS + b
        return F.get(d, F.array_min(F.transform("__f", place)) % BINS)

    dense = F.transform(d, lambda x, j: F.when(is_empty(x), borrowed(j)).otherwise(x))
    low = F.transform(dense, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit((1 << BITS) - 1))), BITS // 4, "0"))
    return rows.select(*own, F.coalesce(F.array_join(low, ""), F.lit("")).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of two fingerprints, 0 to 1; two without words are alike."""
    width = BITS // 4
    part = lambda x, i: F.substring(x, i * width + 1, F.lit(width))
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: part(a, i) == part(b, i)))
    chance = 2.0**-BITS
    estimate = (same / BINS - chance) / (1 - chance)
    return (
        F.when(a == b, 1.0)
        .when((a == "") | (b == ""), 0.0)
        .otherwise(F.greatest(F.least(estimate, F.lit(1.0)), F.lit(0.0)))
    )


def followers(marked: DataFrame) -> DataFrame:
    """(uid, n_chars) of each document with the next one's ``next_uid`` and ``next_fingerprint``.

    Documents are numbered in range partitions, so no task orders them all; after the last comes the first.
    """
    ordered = (
        marked.dropDuplicates(["uid"])
        .repartitionByRange(F.col("doc_id").isNull(), "doc_id", "uid")
        .withColumn("part", F.spark_partition_id())
    )
    ordered = written(ordered, "fingerprint-order")
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    # A row per partition.
    base = parts.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS base", "sum(n) OVER () AS total")
    numbered = written(
        ordered.selectExpr(
            "*", "row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS LAST, uid) - 1 AS place"
        )
        .join(base, "part")
        .selectExpr("uid", "n_chars", "fingerprint", "base + place AS at", "total"),
        "fingerprint-numbers",
    )
    after = numbered.selectExpr("(at + total - 1) % total AS at", "uid AS next_uid", "fingerprint AS next_fingerprint")
    return numbered.select("uid", "n_chars", "at").join(after, "at").drop("at")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit, whose second half is the next document's beginning.

    The next document is that with the next larger id (null last, equal ids by a hash of id and text).
    A null text is empty. Rows with the same id and text are one document and have the same result each.
    An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(" "), text)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.unhex(F.md5(name)).alias("uid"))
    marked = with_fingerprint(rows.withColumn("n_chars", F.length("text").cast("long")), "text", "fingerprint")
    marked = written(marked.drop("text"), "fingerprint-rows")
    follow = written(followers(marked), "fingerprint-next")
    texts = rows.select("uid", "text").dropDuplicates(["uid"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    donors = texts.withColumnsRenamed({"uid": "next_uid"}).join(follow, "next_uid").select(
        "uid", "next_fingerprint", F.substring("text", F.lit(1), half).alias("donated")
    )
    kept = F.substring("text", F.lit(1), (F.length("text") - F.floor(F.length("text") / 2)).cast("int"))
    edited = texts.join(donors, "uid").select("uid", "next_fingerprint", F.concat(kept, "donated").alias("edited"))
    edited = with_fingerprint(edited, "edited", "edited_fingerprint").select(
        "uid", "next_fingerprint", "edited_fingerprint", F.sha2("edited", 256).alias("edited_sha256")
    )
    return marked.join(edited, "uid").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
