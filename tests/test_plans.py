"""Physical plans: what must be pushed down, and what must never appear."""

import pytest
from pyspark.sql import functions as F

import registered
from ledgerlark import schemas
from ledgerlark.operators.newest import newest_per_key
from ledgerlark.operators.running import running_totals
from ledgerlark.plans import gold, training
from ledgerlark.plans.medallion import refresh_silver
from ledgerlark.plans.silver import to_silver
from ledgerlark.sources import demo
from ledgerlark.sources.logs import in_week, known_ids, log_predictions

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_drops_versions_before_the_shuffle(spark):
    text = plan(to_silver(demo.bronze_payments(spark, SF_DIR), "loan_payments"))
    shuffle = text.index("Exchange hashpartitioning(payment_id")
    assert "row_number(), 1, Partial" in text[shuffle:]


def test_gold_reads_prune_columns_and_push_dates(spark, lake):
    text = plan(gold.gold_rows(lake.layer("silver"), "2023-07-01", "2024-12-31"))
    assert "GreaterThanOrEqual(disbursement_date,2023-06-01)" in text
    assert "GreaterThanOrEqual(session_timestamp,2023-06-01T00:00)" in text
    assert "LessThanOrEqual(due_date,2024-07-01)" in text
    assert "amount_paid" not in text and "country" not in text


def test_cohort_read_prunes_partitions(spark, lake):
    users = to_silver(demo.bronze_users(spark, SF_DIR), "users").select("user_id")
    lake.merge_gold(users.selectExpr("user_id", "DATE'2023-07-01' AS observation_date",
                                     "0D AS monthly_volume", "0 AS session_regularity",
                                     "0 AS target_default_30d"), "2023-07-01")
    text = plan(training.training_rows(lake.read("gold", "target_construction"), "2023-07-01"))
    assert "PartitionFilters: [isnotnull(observation_date" in text


def test_week_read_prunes_partitions(spark, lake):
    log_predictions(lake, demo.prediction_logs(spark, SF_DIR))
    text = plan(in_week(lake.read("gold", "prediction_logs"), "2023-08-11"))
    assert "log_date" in text.split("PartitionFilters:")[1].split("]")[0]


def test_log_lookup_reads_the_touched_buckets_only(spark, lake):
    log_predictions(lake, demo.prediction_logs(spark, SF_DIR))
    batch = lake.bucketed(spark.createDataFrame([("p1",)], "prediction_id string"), "prediction_id")
    ids = known_ids(lake, "prediction_logs", batch)
    text = plan(ids)
    assert "bucket" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "log_date" not in text.split("ReadSchema:")[1]
    assert 0 < ids.count() < lake.read("gold", "prediction_logs").count() / 2


@pytest.mark.parametrize("partitions", [2, 60])
def test_running_totals_have_one_plan(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        text = plan(running_totals(spark.range(100).selectExpr("double(id) AS v", "1 AS n"), "v", ["n"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert text.count("Window") >= 2 and "_slice" in text and "ArrayFilter" not in text


@pytest.mark.parametrize(
    "name",
    ["gold_features", "cohort_alerts", "audit_counts", "model_evaluation", "psi_by_variable",
     "stratified_split", "bounded_imputed_features", "rolling_latency", "dialogue_safety_summary"],
)
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(registered.QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


def test_hot_key_sends_one_row_per_task(spark):
    rows = spark.range(0, 30000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id AS v"
    )
    newest = newest_per_key(rows, "k", ["v"])
    assert newest.count() == 20001
    assert newest.where("k = 'hot'").first().v == 29997


def test_silver_takes_in_new_loads_only(spark, lake):
    users = demo.bronze_users(spark, SF_DIR)
    lake.add_load("users", users.where("country < 'NATION_2'"), "one")
    refresh_silver(lake)
    lake.add_load("users", users.where("country >= 'NATION_2' OR country IS NULL"), "two")
    assert lake.loads("users") - lake.merged_loads("users") == {"two"}
    text = plan(lake.read_loads("users", ["two"]))
    assert "load" in text.split("PartitionFilters:")[1].split("]")[0]
    refresh_silver(lake)
    assert lake.loads("users") == lake.merged_loads("users")
    whole = to_silver(users, "users")
    assert sorted(lake.read("silver", "users").collect()) == sorted(whole.collect())


def test_raw_rows_are_dealt_by_the_key_of_their_join(spark):
    """No sort of whole rows to deal them, and no second shuffle of the payments before they meet loans."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = plan(demo.bronze_payments(spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "RoundRobin" not in own
    assert own.count("Exchange hashpartitioning(l_orderkey") == 1 and own.count("Exchange hashpartitioning") == 2


def test_halves_of_a_load_are_worked_out_once(spark):
    loans = demo.bronze_loans(spark, SF_DIR)
    halves = registered.stored_halves({"loans": loans}, {"loans": ["loan_id"]})["loans"]
    assert all("orders.parquet" not in plan(h) for h in halves) and all(h.count() for h in halves)
    got = halves[0].unionByName(halves[1])
    assert got.columns == loans.columns and got.exceptAll(loans).isEmpty() and loans.exceptAll(got).isEmpty()
    assert halves[0].join(halves[1], "loan_id").isEmpty()


def test_stored_silver_has_what_gold_reads(spark):
    stored = registered.stored_silver(spark, SF_DIR)
    assert {t: tuple(df.columns) for t, df in stored.items()} == gold.READS
    want, got = registered.gold_frame(spark, SF_DIR), gold.gold_rows(stored, registered.OBS, registered.AS_OF)
    got, want = ({(r.user_id, r.session_regularity, r.target_default_30d, round(r.monthly_volume, 6)) for r in df.collect()} for df in (got, want))
    assert got == want and got


def test_gold_queries_derive_only_what_decides_their_columns(spark):
    """Amounts and terms only break ties of versions that are the same to Gold: they are not worked out."""
    text = plan(registered.gold_frame(spark, SF_DIR))
    assert "l_shipdate" in text and "payment_date" in text
    for bad in ("l_extendedprice", "l_discount", "amount_due", "term_months", "n_name"):
        assert bad not in text


@pytest.mark.parametrize(
    "table,columns",
    [
        ("users", ("user_id",)),
        ("users", ("user_id", "created_at")),
        ("user_sessions", ("user_id", "session_timestamp")),
        ("loans", ("loan_id", "user_id", "disbursement_date", "amount")),
        ("loans", ("updated_at",)),
        ("loan_payments", ("loan_id", "due_date", "payment_date")),
        ("loan_payments", ("payment_id", "amount_due")),
    ],
)
def test_columns_of_silver_are_those_of_the_whole(spark, table, columns):
    """Versions that tie up to any column, malformed ones among them, from a few values in each column."""
    names = schemas.BRONZE[table].names
    key, values = schemas.SILVER_RULES[table].key, ["2024-01-02", "2024/01/03", "1.5", "x", None]
    own = [F.get(F.array(*map(F.lit, values)), F.pmod(F.xxhash64("id", F.lit(c)), F.lit(5)).cast("int")) for c in names]
    rows = spark.range(4000).select(
        *[(F.col("id") % 300).cast("string").alias(c) if c == key else v.alias(c) for c, v in zip(names, own)]
    )
    want, got = to_silver(rows, table).select(*columns), to_silver(rows, table, columns)
    assert got.schema == want.schema and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()
