"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    bpe,
    fingerprints,
    jaccard,
    neighbours,
    packing,
    passages,
    quality,
    secret_scans,
    sharding,
    substrings,
    tries,
    warc,
    whitening,
)
from ledgerlark.llm.common import prepare
from ledgerlark.session import scratch_path

SHARDS = 16
PACKING_VOCABULARY = "word_bpe_49k.json"
ROUND_TRIP_RANKS = "byte_bpe_50k.tiktoken"

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark, sf_dir):
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


@query
def op2_substring_dedup(spark, sf_dir):
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), digest_only=True)


SQL["op2_substring_dedup"] = rf"""
WITH d AS (
       SELECT row_number() OVER () AS rid, doc_id,
              regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
       FROM documents),
     w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
     r AS (
       SELECT rid, pos, word, count(*) OVER f AS n, string_agg(word, ' ') OVER f AS run
       FROM w
       WINDOW f AS (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND {substrings.WINDOW - 1} FOLLOWING)),
     twice AS (SELECT run FROM r WHERE n = {substrings.WINDOW} GROUP BY run HAVING count(*) > 1),
     m AS (
       SELECT rid, pos, word, n = {substrings.WINDOW} AND run IN (SELECT run FROM twice) AS again FROM r),
     c AS (
       SELECT rid, pos, word, bool_or(again) OVER (
           PARTITION BY rid ORDER BY pos ROWS BETWEEN {substrings.WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone
       FROM m),
     k AS (
       SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
       FROM c GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""


@query
def op3_jaccard_join(spark, sf_dir):
    return jaccard.linked_documents(table(spark, sf_dir, "documents"), k=3, percent=90).drop("key")


@query
def op4_quality(spark, sf_dir):
    return quality.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_line_dedup(spark, sf_dir):
    return passages.dedup_passages(table(spark, sf_dir, "documents"), digest_only=True)


@query
def op6_packing(spark, sf_dir):
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_VOCABULARY)
    )


@query
def op7_bpe(spark, sf_dir):
    return bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(ROUND_TRIP_RANKS),
        public_tokenizers.PATTERN,
    )


@query
def op8_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        "page_id",
        F.length("payload").cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


@query
def op9_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), every=20, count=20)


@query
def op10_fingerprints(spark, sf_dir):
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"))


SQL["op8_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     n AS (SELECT html, max(page_id) AS newest FROM p GROUP BY html),
     r AS (
       SELECT p.page_id, encode(p.html) AS payload, newest,
              octet_length(encode(p.html)) >= {warc.REVISIT_MIN_BYTES} AND p.page_id <> newest AS again
       FROM p JOIN n USING (html))
SELECT page_id,
       CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
       sha1(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN newest END AS refers_to
FROM r
"""


@query
def op11_prefix_trie(spark, sf_dir):
    return tries.conversation_trie(table(spark, sf_dir, "conversations"))


#: The CRC-32 of a decimal number, byte by byte and bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, byte: list_reduce(
        [1, 2, 3, 4, 5, 6, 7, 8],
        lambda v, i: xor(CAST(v // 2 AS BIGINT), CAST(3988292384 * (v % 2) AS BIGINT)),
        xor(CAST(crc AS BIGINT), CAST(byte AS BIGINT))),
    CAST(4294967295 AS BIGINT)))"""

SQL["op11_prefix_trie"] = f"""
WITH said AS (
       SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
       FROM conversations WHERE conv_id IS NOT NULL),
     coded AS (
       SELECT c, turn, octet_length(encode(text)) AS size,
              sha256(concat(octet_length(encode(role)), ':', role, text)) AS t
       FROM said),
     placed AS (SELECT c, t, size, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, t) AS p FROM coded),
     convs AS (SELECT c, c - c % 5 AS base, {CRC32} % 9 AS h FROM (SELECT DISTINCT c FROM placed)),
     joined AS (
       SELECT v.c, 0 AS part, p, t, size FROM convs v JOIN placed s ON s.c = v.base AND p <= h
       UNION ALL SELECT v.c, 1, p, t, size FROM convs v JOIN placed s ON s.c = v.c AND p > h),
     rebuilt AS (SELECT c, t, size, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d FROM joined),
     lengths AS (SELECT v.c, count(d) AS length FROM convs v LEFT JOIN rebuilt USING (c) GROUP BY v.c),
     paths AS (
       SELECT c, d, size, string_agg(t, '') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
       UNION ALL SELECT c, 0, 0, '' FROM convs),
     members AS (SELECT p.*, length = d AS ends FROM paths p JOIN lengths USING (c)),
     nodes AS (
       SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n, any_value(size) AS size,
              sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
       FROM members GROUP BY path),
     parents AS (
       SELECT path, conv_id, left(path, greatest(length(path) - 64, 0)) AS above, depth FROM nodes),
     children AS (SELECT above AS path, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY above),
     sums AS (
       SELECT up.path, sum(CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n - 1) * n.size) AS saved
       FROM (SELECT DISTINCT a.path, b.path AS below FROM members a JOIN members b ON a.c = b.c AND a.d <= b.d) up
       JOIN nodes n ON n.path = up.below LEFT JOIN children k ON k.path = up.below
       GROUP BY up.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth,
       CASE WHEN n.depth > 0 THEN a.conv_id END AS parent_conv_id,
       n.n AS n_convs, coalesce(k.n_children, 0) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN parents p ON p.path = n.path JOIN nodes a ON a.path = p.above
     LEFT JOIN children k ON k.path = n.path JOIN sums s ON s.path = n.path
"""


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_secret_scans(spark, sf_dir):
    return secret_scans.scan_secrets(table(spark, sf_dir, "documents"))
