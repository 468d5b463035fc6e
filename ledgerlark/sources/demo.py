"""Stand-in lending data derived from the star-schema test tables.

The rules make dirty string tables on purpose: several date spellings, unreadable values,
null keys and repeated keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.features import uniform
from ledgerlark.plans.dialogue import dialogue_pairs, score_dialogues
from ledgerlark.plans.scoring import decide
from ledgerlark.plans.training import with_income
from ledgerlark.sources.logs import dialogue_rows, prediction_rows

OBSERVATION_DATE = "2000-07-01"
AS_OF_DATE = "2001-12-31"
SESSION_SHIFT_DAYS = 8603


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A test table with its rows dealt out by a key: each is one file that one task reads.

    By a hash there is no sort of whole rows as in dealing round-robin, and a join on the key needs no other
    shuffle: that takes as many parts as the session's shuffles have.
    """
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table(spark, sf_dir, name).repartition(parts, key)


def _plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), ts)


def _iso(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 19)


def _slashed(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit("/"))


def _day_first(text: Column) -> Column:
    return F.concat(
        F.substring(text, 9, 2), F.lit("-"),
        F.substring(text, 6, 2), F.lit("-"),
        F.substring(text, 1, 4), F.substring(text, 11, 9),
    )


def _spell(text: Column, style: Column) -> Column:
    return (
        F.when(style == 1, _slashed(text))
        .when(style == 2, _day_first(text))
        .otherwise(text)
    )


def _null_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def bronze_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    base = F.lit("1995-01-01 08:00:00").cast("timestamp_ntz")
    people = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("c0", _plus_days(base, k * 37 % 2000))
        .withColumn(
            "later", F.explode(F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        )
        .withColumn("u", _iso(_plus_days(F.col("c0"), F.col("later"))))
    )
    return people.select(
        _null_if(k % 50 == 49, k.cast("string")).alias("user_id"),
        F.when(k % 40 == 7, "invalid-date")
        .otherwise(_spell(_iso(F.col("c0")), k % 4))
        .alias("created_at"),
        F.col("n_name").alias("country"),
        F.col("u").alias("updated_at"),
        _slashed(F.col("u")).alias("ingestion_timestamp"),
    )


def bronze_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    text = _iso(_plus_days(F.col("ts"), F.lit(-SESSION_SHIFT_DAYS)))
    return dealt(spark, sf_dir, "events", "event_id").select(
        _null_if(e % 101 == 0, e.cast("string")).alias("session_id"),
        _null_if(e % 103 == 0, F.col("user_id").cast("string")).alias("user_id"),
        F.when(e % 107 == 0, "invalid-date")
        .otherwise(_spell(text, e % 3))
        .alias("session_timestamp"),
    )


def bronze_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    raised = (price * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(18,2)")
    versions = F.when(k % 12 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    stamp = _iso(_plus_days(F.col("o_orderdate"), F.col("version")))
    return (
        dealt(spark, sf_dir, "orders", "o_orderkey")
        .withColumn("version", F.explode(versions))
        .select(
            _null_if(k % 199 == 0, k.cast("string")).alias("loan_id"),
            _null_if(k % 211 == 0, F.col("o_custkey").cast("string")).alias("user_id"),
            F.when(k % 89 == 0, "invalid-date")
            .otherwise(_spell(F.substring(_iso(F.col("o_orderdate")), 1, 10), k % 3))
            .alias("disbursement_date"),
            F.when(k % 97 == 0, "invalid-amount")
            .when(F.col("version") == 1, raised.cast("string"))
            .otherwise(price.cast("string"))
            .alias("amount"),
            (F.lit(6) + F.lit(6) * (k % 4)).cast("string").alias("term_months"),
            stamp.alias("updated_at"),
            stamp.alias("ingestion_timestamp"),
        )
    )


def bronze_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    h = F.col("l_partkey") * 7 + F.col("l_suppkey") * 13
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    paid = (price * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))).cast(
        "decimal(18,2)"
    )
    due = F.date_add(F.to_date("o_orderdate"), (line * 30).cast("int"))
    paid_on = F.date_add(due, ((h + line) % 40 - 8).cast("int"))

    def day(d: Column) -> Column:
        return d.cast("string")

    return (
        dealt(spark, sf_dir, "lineitem", "l_orderkey")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            _null_if(
                h % 151 == 0, F.concat_ws("-", F.col("l_orderkey"), line)
            ).alias("payment_id"),
            _null_if(h % 157 == 0, F.col("l_orderkey").cast("string")).alias("loan_id"),
            F.when(h % 163 == 0, "invalid-date")
            .otherwise(_spell(day(due), line % 3))
            .alias("due_date"),
            _null_if(h % 50 == 0, day(paid_on)).alias("payment_date"),
            price.cast("string").alias("amount_due"),
            F.when(h % 167 == 0, "n/a").otherwise(paid.cast("string")).alias("amount_paid"),
            _iso(F.col("l_shipdate")).alias("updated_at"),
            _iso(
                F.timestamp_add("SECOND", F.col("l_partkey").cast("int"), F.col("l_shipdate"))
            ).alias("ingestion_timestamp"),
        )
    )


BRONZE_BUILDERS = {
    "users": bronze_users,
    "user_sessions": bronze_sessions,
    "loans": bronze_loans,
    "loan_payments": bronze_payments,
}


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BRONZE_BUILDERS.items()}


# --- stand-ins for the logs -----------------------------------------------------------
BASELINE_UNTIL = "2024-01-15"
STABLE_WEEK = "2024-01-22"
DRIFTED_WEEK = "2024-01-29"
DRIFT_FACTOR = 2.2

# A lexicon and patterns that do occur in the test conversations.
CUSTOM_WORDS = ("hate", "that", "keit", "eaux")
CUSTOM_INJECTION = ("the and", "en ", "ou.", "^in ")
CUSTOM_FAILURES = ("thth", "un[g]", "la ")


def scored_requests(spark: SparkSession, sf_dir: str, drifted: bool = False) -> DataFrame:
    """One request per event, with a hash-based probability that is sometimes missing."""
    e = F.col("event_id")
    factor = F.lit(1.0)
    if drifted:
        late = F.col("ts") > F.lit(f"{STABLE_WEEK} 23:59:59").cast("timestamp_ntz")
        factor = F.when(late, F.lit(DRIFT_FACTOR)).otherwise(F.lit(1.0))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("p"), e.cast("string")).alias("prediction_id"),
        F.col("ts").alias("timestamp"),
        _null_if(e % 103 == 0, F.col("user_id").cast("string")).alias("user_id"),
        _null_if(e % 59 == 0, F.col("value") * 40.0 * factor).alias("monthly_volume"),
        (e * 7 % 31).cast("int").alias("session_regularity"),
        (F.col("value") * 100.0 * factor + 15000.0).alias("income"),
        _null_if(e % 61 == 0, uniform(e.cast("string"), 7) * 0.2).alias("probability_of_default"),
        F.col("value").alias("latency_ms"),
        F.col("event_type").alias("service"),
    )


def prediction_logs(spark: SparkSession, sf_dir: str, drifted: bool = False) -> DataFrame:
    return prediction_rows(decide(scored_requests(spark, sf_dir, drifted)))


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with their answers, spread over fifteen days."""
    conv, turn = F.col("conv_id"), F.col("turn")
    start = F.lit("2024-01-15 06:00:00").cast("timestamp_ntz")
    at = F.timestamp_add("HOUR", turn.cast("int"), _plus_days(start, conv % 15))
    return dialogue_pairs(table(spark, sf_dir, "conversations")).select(
        F.concat_ws("-", conv, turn).alias("dialogue_id"),
        at.alias("timestamp"),
        _null_if(conv % 97 == 0, conv.cast("string")).alias("user_id"),
        "user_query",
        "bot_response",
    )


def dialogue_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_rows(
        score_dialogues(dialogues(spark, sf_dir), CUSTOM_WORDS, CUSTOM_INJECTION, CUSTOM_FAILURES)
    )


def untidy_requests(gold: DataFrame) -> DataFrame:
    """Gold users as scoring requests, some of them broken in each possible way."""
    u = F.col("user_id").cast("bigint")
    return with_income(gold).select(
        F.when(u % 29 == 0, "").otherwise(F.col("user_id")).alias("user_id"),
        F.when(u % 31 == 0, F.lit(-10.0)).otherwise(F.col("monthly_volume")).alias("monthly_volume"),
        F.when(u % 37 == 0, 35)
        .when(u % 41 == 0, -1)
        .otherwise(F.col("session_regularity"))
        .alias("session_regularity"),
        F.when(u % 43 == 0, F.lit(-5000.0))
        .when(u % 47 == 0, F.lit(float("nan")))
        .when(u % 53 != 0, F.col("income"))
        .alias("income"),
    )


def untidy_features(gold: DataFrame) -> DataFrame:
    """Gold users with values out of bounds, missing, infinite or not a number."""
    u = F.col("user_id").cast("bigint")
    return with_income(gold).select(
        "user_id",
        F.when(u % 11 == 0, -F.col("monthly_volume") - 1.0)
        .when(u % 13 == 0, F.lit(float("inf")))
        .otherwise(F.col("monthly_volume") + u.cast("double"))
        .alias("monthly_volume"),
        (u % 45 - 5).cast("int").alias("session_regularity"),
        F.when(u % 17 == 0, F.lit(float("inf")))
        .when(u % 19 == 0, -F.col("income"))
        .when(u % 23 == 0, F.lit(float("nan")))
        .when(u % 7 != 0, F.round("income", 2))
        .alias("income"),
        "target_default_30d",
    )


def scored_targets(gold: DataFrame) -> DataFrame:
    """Gold users with a score that leans on the target and has many ties."""
    u = uniform(F.col("user_id"), 11)
    blend = u * 0.6 + F.col("target_default_30d") * 0.4
    return gold.select(
        "user_id",
        F.col("target_default_30d").alias("label"),
        (F.floor(blend * 100.0) / 100.0).alias("probability"),
    )
