"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions import policy
from ledgerlark.functions.features import uniform
from ledgerlark.operators.audit import audit_warnings, audit_wide
from ledgerlark.operators.boosting import feature_cuts
from ledgerlark.operators.lexicon import lexicon_matches, with_toxicity
from ledgerlark.operators.psi import bin_counts, bin_edges, long_form
from ledgerlark.operators.ranking import class_curves, model_metrics
from ledgerlark.plans import cohorts, drift, gold, scoring, telemetry, training
from ledgerlark.plans.dialogue import safety_summary
from ledgerlark.plans.medallion import build_gold, refresh_silver
from ledgerlark.plans.quality import audit_new_loads, audit_totals
from ledgerlark.plans.silver import all_silver, to_silver
from ledgerlark.plans.sketches import RANK_ERROR, latency_percentiles, refresh_sketches, sketched_profile
from ledgerlark.plans.tracking import drift_rows
from ledgerlark.schemas import FEATURES
from ledgerlark.session import scratch_path, written
from ledgerlark.sources import demo
from ledgerlark.sources.lake import Lake
from ledgerlark.sources.logs import in_week, log_dialogues, log_predictions
from ledgerlark.sources.raw import load_bronze
from ledgerlark.streaming.layers import stream_to_bronze, stream_to_silver
from ledgerlark.streaming.monitoring import (
    latency_windows,
    stream_predictions,
    trailing_latency,
    weekly_bin_counts,
    weekly_psi,
)
from ledgerlark.streaming.tables import ReplacingTable, keep_current

OBS = demo.OBSERVATION_DATE
AS_OF = demo.AS_OF_DATE
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def silver(spark: SparkSession, sf_dir: str, **reads: tuple[str, ...]) -> dict[str, DataFrame]:
    """Silver in the columns that Gold reads, or those given for a table."""
    return all_silver(demo.bronze(spark, sf_dir), gold.READS | reads)


def stored_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver worked out once, in the columns that Gold reads."""
    return {t: written(df, t) for t, df in silver(spark, sf_dir).items()}


def stored_halves(bronze: dict[str, DataFrame], keys: dict[str, list[str]]) -> dict[str, list[DataFrame]]:
    """Each of the named tables worked out once and stored as two halves, told apart by a hash of the keys."""
    halves = {}
    for t, columns in keys.items():
        half = F.pmod(F.xxhash64(*[F.coalesce(c, F.lit("")) for c in columns]), F.lit(2)).cast("int")
        rows = written(bronze[t].withColumn("half", half), f"half-{t}", "half")
        halves[t] = [rows.where(F.col("half") == n).select(*bronze[t].columns) for n in (0, 1)]
    return halves


def gold_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_rows(silver(spark, sf_dir), OBS, AS_OF)


def _r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def silver_users(spark, sf_dir):
    return to_silver(demo.bronze_users(spark, sf_dir), "users")


@query
def silver_sessions(spark, sf_dir):
    return to_silver(demo.bronze_sessions(spark, sf_dir), "user_sessions")


@query
def silver_loans(spark, sf_dir):
    return to_silver(demo.bronze_loans(spark, sf_dir), "loans")


@query
def silver_payments(spark, sf_dir):
    return to_silver(demo.bronze_payments(spark, sf_dir), "loan_payments")


@query
def monthly_volume(spark, sf_dir):
    return _r6(gold.monthly_volume(silver_loans(spark, sf_dir), OBS), "monthly_volume")


@query
def session_regularity(spark, sf_dir):
    return gold.session_regularity(silver_sessions(spark, sf_dir), OBS)


@query
def default_target(spark, sf_dir):
    layer = silver(spark, sf_dir)
    return gold.default_target(
        layer["users"], layer["loan_payments"], layer["loans"], OBS, AS_OF
    )


@query
def payments_past_due(spark, sf_dir):
    """Days late, or overdue as of the fixed day, of every valid payment."""
    late = gold.days_past_due(AS_OF)
    return silver_payments(spark, sf_dir).select(
        "payment_id",
        late.alias("days_past_due"),
        (late > gold.DEFAULT_DAYS_PAST_DUE).alias("is_default"),
    )


@query
def gold_features(spark, sf_dir):
    return _r6(gold_frame(spark, sf_dir), "monthly_volume")


def _rates(spark, sf_dir):
    layer = silver(spark, sf_dir, users=("user_id", "created_at"))
    return cohorts.cohort_default_rates(
        gold.gold_rows(layer, OBS, AS_OF), layer["users"], OBS
    )


@query
def cohort_default_rate(spark, sf_dir):
    return _rates(spark, sf_dir).withColumn("default_rate", F.round("default_rate", 6))


@query
def cohort_alerts(spark, sf_dir):
    return cohorts.cohort_alerts(_rates(spark, sf_dir)).withColumn(
        "default_rate", F.round("default_rate", 6)
    )


def lake_at(spark: SparkSession, label: str) -> Lake:
    """A fresh lake in the shared scratch folder."""
    lake = Lake(spark, scratch_path(spark, label), buckets=4)
    lake.create()
    return lake


# --- Bronze and Silver ------------------------------------------------------------------
@query
def csv_ingest(spark, sf_dir):
    lake, folder = lake_at(spark, "csv"), scratch_path(spark, "csv-files")
    demo.bronze_sessions(spark, sf_dir).write.option("header", True).csv(f"{folder}/user_sessions.csv")
    load_bronze(lake, folder)
    return lake.read("bronze", "user_sessions")


@query
def json_ingest(spark, sf_dir):
    lake, folder = lake_at(spark, "json"), scratch_path(spark, "json-files")
    demo.bronze_loans(spark, sf_dir).write.json(f"{folder}/loans.json")
    load_bronze(lake, folder, json_form="lines")
    return lake.read("bronze", "loans")


#: Records of an array file, about.
ARRAY_ROWS = 1_000


def write_arrays(df: DataFrame, path: str) -> None:
    """A folder of JSON files, each with one array of records; the more rows, the more files."""
    files = df.count() // ARRAY_ROWS + 1
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    arrays = df.groupBy(bucket.alias("bucket")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query
def json_array_ingest(spark, sf_dir):
    """A folder of files that each hold one array of records."""
    lake, folder = lake_at(spark, "array"), scratch_path(spark, "array-files")
    write_arrays(demo.bronze_users(spark, sf_dir), f"{folder}/users.json")
    load_bronze(lake, folder)
    return lake.read("bronze", "users")


@query
def csv_quoted_ingest(spark, sf_dir):
    """Whole document texts, with line breaks and quotes, as the country of a user."""
    lake, folder = lake_at(spark, "quoted"), scratch_path(spark, "quoted-files")
    none = F.lit(None).cast("string")
    users = demo.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("user_id"),
        F.col("source").alias("created_at"),
        F.concat(F.lit('"'), F.col("text"), F.lit('", ')).alias("country"),
        none.alias("updated_at"),
        none.alias("ingestion_timestamp"),
    )
    whole = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    users.write.options(**whole).csv(f"{folder}/users.csv")
    load_bronze(lake, folder, multi_line=True)
    return lake.read("bronze", "users")


@query
def audit_counts(spark, sf_dir):
    return audit_wide(demo.bronze(spark, sf_dir))


@query
def audit_warning_lines(spark, sf_dir):
    return audit_warnings(demo.bronze(spark, sf_dir))


@query
def incremental_audit(spark, sf_dir):
    """Two loads of every table, which share keys, counted one after the other."""
    lake, bronze = lake_at(spark, "audit"), demo.bronze(spark, sf_dir)
    halves = stored_halves(bronze, {t: df.columns for t, df in bronze.items()})
    for part in (0, 1):
        load_bronze(lake, {t: own[part] for t, own in halves.items()})
        audit_new_loads(lake)
    return audit_totals(lake)


@query
def layer_counts(spark, sf_dir):
    """Rows of the stored layers after a load and a refresh."""
    lake = lake_at(spark, "counts")
    load_bronze(lake, demo.bronze(spark, sf_dir))
    refresh_silver(lake)
    return lake.row_counts().withColumnRenamed("table", "table_name")


@query
def silver_upsert(spark, sf_dir):
    """Two overlapping loads of loans, one after the other."""
    loads = demo.bronze_loans(spark, sf_dir)
    lake = lake_at(spark, "upsert")
    for part in ("updated_at < '1999-01-01'", "updated_at >= '1998-01-01'"):
        lake.upsert_silver({"loans": to_silver(loads.where(part), "loans")})
    return lake.read("silver", "loans")


# --- Gold -------------------------------------------------------------------------------
@query
def gold_merge_second_run(spark, sf_dir):
    """Two observation dates merged into Gold, the second one twice."""
    layer = stored_silver(spark, sf_dir)
    lake = lake_at(spark, "gold")
    for date in ("2000-06-01", OBS, OBS):
        lake.merge_gold(gold.gold_rows(layer, date, AS_OF), date)
    return _r6(lake.read("gold", "target_construction"), "monthly_volume")


@query
def gold_daily_partials(spark, sf_dir):
    """Two dates from the rows of days, half of the loans and sessions coming late: the first date is
    built before and after them."""
    lake = lake_at(spark, "daily")
    bronze = demo.bronze(spark, sf_dir)
    halves = stored_halves(bronze, {"loans": ["loan_id"], "user_sessions": ["session_id"]})
    late, early = ({t: own[n] for t, own in halves.items()} for n in (0, 1))
    load_bronze(lake, {**bronze, **early})
    refresh_silver(lake)
    build_gold(lake, "2000-06-01", AS_OF)
    load_bronze(lake, late)
    refresh_silver(lake)
    for date in ("2000-06-01", OBS):
        build_gold(lake, date, AS_OF)
    return _r6(lake.read("gold", "target_construction"), "monthly_volume")


@query
def pipeline_cohorts(spark, sf_dir):
    """The whole flow through stored layers."""
    lake = lake_at(spark, "pipeline")
    load_bronze(lake, demo.bronze(spark, sf_dir))
    refresh_silver(lake)
    build_gold(lake, OBS, AS_OF)
    return _r6(
        cohorts.cohort_default_rates(
            lake.read("gold", "target_construction"), lake.read("silver", "users"), OBS
        ),
        "default_rate",
    )


@query
def cohort_report(spark, sf_dir):
    return cohorts.cohort_report(_rates(spark, sf_dir), OBS)


# --- Training ---------------------------------------------------------------------------
@query
def training_cohort(spark, sf_dir):
    """One cohort read back from a Gold table that holds two."""
    layer = stored_silver(spark, sf_dir)
    lake = lake_at(spark, "cohorts")
    for date in ("2000-06-01", OBS):
        lake.merge_gold(gold.gold_rows(layer, date, AS_OF), date)
    rows = training.training_rows(lake.read("gold", "target_construction"), OBS)
    return _r6(rows.drop("income"), "monthly_volume")


@query
def synthetic_income(spark, sf_dir):
    rows = training.training_rows(gold_frame(spark, sf_dir), OBS)
    return _r6(rows.select("user_id", "income"), "income")


def _split(spark, sf_dir):
    rows = written(demo.untidy_features(gold_frame(spark, sf_dir)), "untidy")
    return training.split_rows(rows)


@query
def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("user_id", "target_default_30d", "is_test")


@query
def bounded_imputed_features(spark, sf_dir):
    split = written(_split(spark, sf_dir), "split")
    return _r6(training.impute(split), *FEATURES)


@query
def class_weight(spark, sf_dir):
    train = _split(spark, sf_dir).where(~F.col("is_test"))
    return _r6(training.class_weight(train), "class_weight")


def _metrics(spark, sf_dir):
    metrics = model_metrics(demo.scored_targets(gold_frame(spark, sf_dir)))
    return _r6(metrics, *[c for c, t in metrics.dtypes if t == "double"])


@query
def roc_auc_gini(spark, sf_dir):
    return _metrics(spark, sf_dir).select("roc_auc", "gini_index")


@query
def ks_statistic(spark, sf_dir):
    return _metrics(spark, sf_dir).select("ks_statistic")


@query
def class_cdfs(spark, sf_dir):
    curves = class_curves(demo.scored_targets(gold_frame(spark, sf_dir)), "label", "probability")
    return _r6(
        curves.select("score", "positives_cdf", "negatives_cdf"), "positives_cdf", "negatives_cdf"
    )


@query
def accuracy_logloss(spark, sf_dir):
    return _metrics(spark, sf_dir).select("accuracy", "log_loss")


@query
def model_evaluation(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query
def gbt_scores(spark, sf_dir):
    """The model of the fixed parameters, trained on the cohort and answering every user of it.

    Its probabilities are its own, so what is certain is returned: they lie between 0 and 1,
    limit and decision follow the policy, and a saved and loaded model answers the same.
    """
    rows = written(training.training_rows(gold_frame(spark, sf_dir), OBS), "cohort")
    prepared = written(training.impute(written(training.split_rows(rows), "split")), "prepared")
    model = training.fit(prepared.where(~F.col("is_test")))
    path = scratch_path(spark, "model")
    training.save_model(model, path)
    again = training.predict(training.load_model(path), prepared).select(
        "user_id", F.col("probability_of_default").alias("again")
    )
    pd = F.col("probability_of_default")
    return scoring.score(prepared, model).join(again, "user_id").select(
        "user_id",
        pd.between(0.0, 1.0).alias("in_range"),
        (F.col("credit_limit") == policy.credit_limit(pd, F.col("income"))).alias("limit_fits"),
        (F.col("decision") == policy.credit_decision(pd)).alias("decision_fits"),
        (pd == F.col("again")).alias("same_when_loaded"),
        "status",
    )


def _training_part(spark, sf_dir) -> DataFrame:
    prepared = training.impute(written(_split(spark, sf_dir), "split"))
    return written(prepared.where(~F.col("is_test")), "training-part")


@query
def boosting_cuts(spark, sf_dir):
    """Where the second-order learner may split each feature of the training part."""
    cuts = feature_cuts(_training_part(spark, sf_dir), FEATURES)
    rows = [(f, float(c)) for f in FEATURES for c in cuts[f]]
    return _r6(spark.createDataFrame(rows, "variable string, cut double"), "cut")


@query
def boosted_stump(spark, sf_dir):
    """One tree of one split over all rows and columns: its feature, cut and the margins of both sides."""
    train = _training_part(spark, sf_dir)
    model = training.fit_second_order(train, trees=1, depth=1, row_share=1.0, column_share=1.0)
    root = model.trees[0]
    rows = [(root.feature, root.cut, root.left.value, root.right.value)]
    stump = spark.createDataFrame(rows, "variable string, cut double, below double, above double")
    return _r6(stump, "cut", "below", "above")


@query
def second_order_scores(spark, sf_dir):
    """As ``gbt_scores``, by second-order trees with the fixed parameters, saved as a table of trees."""
    rows = written(training.training_rows(gold_frame(spark, sf_dir), OBS), "cohort")
    prepared = written(training.impute(written(training.split_rows(rows), "split")), "prepared")
    model = training.fit_second_order(prepared.where(~F.col("is_test")))
    path = scratch_path(spark, "trees")
    training.save_model(model, path, spark)
    pd = F.col("probability_of_default")
    again = written(training.predict(training.load_model(path), prepared).select("user_id", pd.alias("again")), "again")
    return written(scoring.score(prepared, model), "scored").join(again, "user_id").select(
        "user_id",
        pd.between(0.0, 1.0).alias("in_range"),
        (F.col("credit_limit") == policy.credit_limit(pd, F.col("income"))).alias("limit_fits"),
        (F.col("decision") == policy.credit_decision(pd)).alias("decision_fits"),
        (pd == F.col("again")).alias("same_when_loaded"),
        "status",
    )


@query
def model_answers(spark, sf_dir):
    """Every Gold user as a request, answered in batch and on a stream by a saved and loaded model.

    Its probabilities are its own; what is certain is returned: the logged answer has the probability that
    the model gives, and limit and decision follow the policy.
    """
    rows = written(training.training_rows(gold_frame(spark, sf_dir), OBS), "cohort")
    path = scratch_path(spark, "model")
    training.save_model(training.fit(rows), path)
    model = training.load_model(path)
    requests = rows.select(
        "user_id", "monthly_volume", "session_regularity", "income",
        F.lit(f"{OBS} 12:00:00").cast("timestamp_ntz").alias("timestamp"), F.lit(5.0).alias("latency_ms"),
    )
    lake, folder = lake_at(spark, "model-answers"), scratch_path(spark, "model-requests")
    by = lambda channel: requests.withColumn("prediction_id", F.concat(F.lit(f"{channel}-"), F.col("user_id")))
    scoring.score_batch(lake, by("batch"), model)
    by("stream").write.parquet(folder)
    stream = spark.readStream.schema(by("stream").schema).parquet(folder)
    stream_predictions(lake, stream, model, f"{lake.root}/checkpoints/answers").awaitTermination()
    own = training.predict(model, rows).select("user_id", F.col("probability_of_default").alias("own"))
    pd = F.col("probability_of_default")
    return lake.read("gold", "prediction_logs").join(own, "user_id").select(
        F.substring_index("prediction_id", "-", 1).alias("channel"),
        "user_id",
        (pd == F.col("own")).alias("same_as_model"),
        (F.col("credit_limit") == policy.credit_limit(pd, F.col("income"))).alias("limit_fits"),
        (F.col("decision") == policy.credit_decision(pd)).alias("decision_fits"),
        "status",
        "is_anomaly",
    )


@query
def training_gate(spark, sf_dir):
    """The training flow on two Gold dates: a label without pattern is turned away with nothing
    stored, one that follows the features is accepted and tracked."""
    lake = lake_at(spark, "gate")
    rows = gold_frame(spark, sf_dir)
    noise = (uniform(F.col("user_id"), 3) < 0.5).cast("int")
    clear = (F.col("user_id").cast("bigint") % 3 == 0).cast("int")
    volume = F.when(clear == 1, F.lit(90000.0)).otherwise(F.lit(10.0)) + uniform(F.col("user_id"), 5)
    dates = {"2000-06-01": rows.withColumn(training.LABEL, noise)}
    dates[OBS] = rows.withColumns({training.LABEL: clear, "monthly_volume": volume})
    accepted = []
    for date, frame in dates.items():
        frame = frame.withColumn("observation_date", F.lit(date).cast("date"))
        lake.merge_gold(frame, date)
        try:
            training.train_pipeline(lake, date, scratch_path(spark, "gated"), run_id=date)
            accepted.append(date)
        except training.ModelRejected:
            pass
    tracked = lake.read("gold", "run_metrics").where("kind = 'metric'").select("run_id", "name")
    return tracked.withColumn("accepted", F.col("run_id").isin(accepted))


# --- Scoring ----------------------------------------------------------------------------
@query
def credit_decisions(spark, sf_dir):
    rows = training.with_income(gold_frame(spark, sf_dir)).withColumn(
        "pd", F.round(uniform(F.col("user_id"), 7) * 0.2, 4)
    )
    return rows.select(
        "user_id",
        "pd",
        F.round(policy.credit_limit(F.col("pd"), F.col("income")), 6).alias("credit_limit"),
        policy.credit_decision(F.col("pd")).alias("decision"),
    )


@query
def request_validation(spark, sf_dir):
    checked = scoring.with_reasons(demo.untidy_requests(gold_frame(spark, sf_dir)))
    reasons = F.concat_ws(",", "rejection_reasons")
    return checked.groupBy(reasons.alias("reasons")).agg(F.count(F.lit(1)).alias("requests"))


@query
def scoring_fallback(spark, sf_dir):
    answers = scoring.decide(demo.scored_requests(spark, sf_dir))
    return _r6(
        answers.select(
            "prediction_id", "probability_of_default", "credit_limit", "decision", "status"
        ),
        "probability_of_default",
        "credit_limit",
    )


@query
def prediction_log_anomalies(spark, sf_dir):
    """Logged twice, kept once."""
    lake = lake_at(spark, "predictions")
    answers = scoring.decide(demo.scored_requests(spark, sf_dir))
    for _ in range(2):
        log_predictions(lake, answers)
    logs = lake.read("gold", "prediction_logs").drop("log_date")
    return _r6(logs, "income", "probability_of_default", "credit_limit", "monthly_volume")


@query
def batch_repeated_requests(spark, sf_dir):
    """Requests that differ in nothing but their id: each is answered and logged."""
    e = F.col("event_id")
    requests = demo.table(spark, sf_dir, "events").select(
        F.concat(F.lit("p"), e).alias("prediction_id"),
        F.col("ts").alias("timestamp"),
        F.lit("same").alias("user_id"),
        (e % 3 * 10.0).alias("monthly_volume"),
        (e % 33).cast("int").alias("session_regularity"),
        F.lit(1000.0).alias("income"),
        F.lit(5.0).alias("latency_ms"),
    )
    lake = lake_at(spark, "repeated")
    answers, rejected = scoring.score_batch(lake, requests, None)
    logged = lake.read("gold", "prediction_logs").select("prediction_id", F.lit(True).alias("logged"))
    answered = answers.select("prediction_id", F.col("decision").alias("answer")).unionByName(
        rejected.select("prediction_id", F.concat_ws(",", "rejection_reasons").alias("answer"))
    )
    return answered.join(logged, "prediction_id", "left").withColumn(
        "logged", F.coalesce("logged", F.lit(False))
    )


# --- Monitoring -------------------------------------------------------------------------
@query
def rolling_latency(spark, sf_dir):
    rows = telemetry.rolling_latency(demo.table(spark, sf_dir, "events"), "event_type", "ts", "value")
    return _r6(rows, "rolling_mean")


@query
def rolling_latency_dirty(spark, sf_dir):
    """The same with missing, NaN and huge latencies."""
    e = F.col("event_id")
    events = demo.table(spark, sf_dir, "events").withColumn(
        "value",
        F.when(e % 7 == 0, F.lit(None).cast("double"))
        .when(e % 501 == 0, F.lit(float("nan")))
        .when(e % 1001 == 1, F.lit(1e21))
        .otherwise(F.col("value")),
    )
    rows = telemetry.rolling_latency(events, "event_type", "ts", "value")
    mean = F.col("rolling_mean")
    return rows.select(
        "event_type",
        "ts",
        "window_requests",
        F.isnan(mean).alias("not_a_number"),
        # Rounded to six digits below the point, or six in all where it is large.
        F.when(mean < 1e9, F.round(mean, 6)).alias("rolling_mean"),
        F.when((mean >= 1e9) & ~F.isnan(mean), F.round(mean / 1e15)).alias("in_peta"),
    )


@query
def latency_sla(spark, sf_dir):
    sla = telemetry.latency_sla(demo.table(spark, sf_dir, "events"), "event_type", "value")
    return _r6(sla, "compliance")


@query
def telemetry_summary(spark, sf_dir):
    days = telemetry.daily_summary(demo.prediction_logs(spark, sf_dir))
    return _r6(days, *[c for c, t in days.dtypes if t == "double"])


def _sketched(spark, sf_dir, label: str) -> Lake:
    """A lake whose prediction log came in two parts, each sketched as it came."""
    lake = lake_at(spark, label)
    logs = demo.prediction_logs(spark, sf_dir, drifted=True)
    for part in (0, 1):
        log_predictions(lake, logs.where(F.pmod(F.xxhash64("prediction_id"), F.lit(2)) == part))
        refresh_sketches(lake)
    return lake


@query
def sketched_percentiles(spark, sf_dir):
    """Latency percentiles of every day from its sketch, held against the rank that they have."""
    lake = _sketched(spark, sf_dir, "percentiles")
    found = latency_percentiles(lake, [0.5, 0.95, 0.99])
    logs = lake.read("gold", "prediction_logs").select("log_date", F.col("latency_ms").alias("own"))
    ranks = found.join(logs, "log_date").groupBy("log_date", "rank", "latency_ms").agg(
        F.avg((F.col("own") <= F.col("latency_ms")).cast("double")).alias("upto"),
        F.avg((F.col("own") < F.col("latency_ms")).cast("double")).alias("below"),
    )
    rank = F.col("rank")
    near = (F.col("below") <= rank + RANK_ERROR) & (F.col("upto") >= rank - RANK_ERROR)
    return ranks.select("log_date", "rank", near.alias("within_rank_error"))


@query
def drift_sketched_baseline(spark, sf_dir):
    """The PSI of the drifted week against two weeks of sketches, held against the exact one."""
    lake = _sketched(spark, sf_dir, "sketched-baseline")
    logs = lake.read("gold", "prediction_logs")
    profile = written(sketched_profile(lake, "2000-01-01", "2024-01-14"), "sketched-profile")
    week = in_week(logs, demo.DRIFTED_WEEK)
    exact = drift.prediction_drift(week, written(drift.baseline_profile(_before(logs)), "exact-profile"))
    exact = exact.select("variable_name", F.col("psi_value").alias("exact"))
    psi = drift.prediction_drift(week, profile).join(exact, "variable_name")
    near = F.abs(F.col("psi_value") - F.col("exact")) <= 0.02 + 0.05 * F.col("exact")
    return psi.select("variable_name", "drift_status", "alert_triggered", near.alias("near_exact"))


def _before(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp") < F.lit(demo.BASELINE_UNTIL).cast("timestamp_ntz"))


@query
def decile_edges(spark, sf_dir):
    base = long_form(_before(demo.prediction_logs(spark, sf_dir)), drift.PREDICTION_VARIABLES)
    edges = bin_edges(base).select("variable", F.posexplode("edges").alias("position", "edge"))
    return _r6(edges, "edge")


@query
def week_logs(spark, sf_dir):
    """One week read back from the stored prediction log."""
    lake = lake_at(spark, "week-logs")
    log_predictions(lake, demo.prediction_logs(spark, sf_dir))
    week = in_week(lake.read("gold", "prediction_logs"), demo.STABLE_WEEK)
    return week.select("prediction_id", "timestamp", "log_date", "is_anomaly")


@query
def psi_bin_counts(spark, sf_dir):
    """Baseline and production rows in each bin, empty bins included."""
    logs = demo.prediction_logs(spark, sf_dir, drifted=True)
    base = long_form(_before(logs), drift.PREDICTION_VARIABLES)
    week = long_form(in_week(logs, demo.DRIFTED_WEEK), drift.PREDICTION_VARIABLES)
    return bin_counts(bin_edges(base), expected=base, actual=week)


@query
def psi_by_variable(spark, sf_dir):
    logs = demo.prediction_logs(spark, sf_dir, drifted=True)
    profile = drift.baseline_profile(_before(logs))
    psi = drift.prediction_drift(in_week(logs, demo.DRIFTED_WEEK), profile)
    return _r6(
        psi.select("variable_name", "psi_value", "drift_status", "alert_triggered"), "psi_value"
    )


def _week(spark, sf_dir, date, profile=None):
    logs = demo.prediction_logs(spark, sf_dir, drifted=True)
    talks = demo.dialogue_logs(spark, sf_dir)
    profile = drift.baseline_profile(_before(logs)) if profile is None else profile
    return drift.weekly_metrics(logs, talks, profile, date)


@query
def weekly_drift_metrics(spark, sf_dir):
    """Stored twice for the same day, kept once."""
    lake = lake_at(spark, "drift")
    metrics = written(_week(spark, sf_dir, demo.STABLE_WEEK), "week")
    for _ in range(2):
        lake.replace_drift_metrics(metrics)
    return _r6(lake.read("gold", "drift_metrics"), "psi_value")


@query
def drift_week_comparison(spark, sf_dir):
    base = _before(demo.prediction_logs(spark, sf_dir, drifted=True))
    profile = written(drift.baseline_profile(base), "profile")
    pairs = drift.compare_weeks(
        _week(spark, sf_dir, demo.STABLE_WEEK, profile),
        _week(spark, sf_dir, demo.DRIFTED_WEEK, profile),
    )
    return _r6(pairs, *[c for c, t in pairs.dtypes if t == "double"])


@query
def drift_on_gold_baseline(spark, sf_dir):
    """A weekly run, twice, against all Gold rows with a model's probabilities.

    The probabilities are the model's own: of that variable only what is certain is returned, that its PSI
    is not negative and its class fits it. ``tracked_rows`` is how many rows the run has tracked.
    """
    lake = lake_at(spark, "gold-drift")
    lake.merge_gold(gold_frame(spark, sf_dir), OBS)
    stored = lake.read("gold", "target_construction")
    model = training.fit(training.training_rows(stored, OBS))
    profile = written(drift.baseline_profile(training.baseline_rows(stored, model)), "profile")
    log_predictions(lake, demo.prediction_logs(spark, sf_dir))
    log_dialogues(lake, demo.dialogue_logs(spark, sf_dir))
    for _ in range(2):
        drift.run_weekly_drift(lake, demo.STABLE_WEEK, profile)
    tracked = lake.read("gold", "run_metrics").agg(F.count(F.lit(1)).alias("tracked_rows"))
    psi, known = F.col("psi_value"), F.col("variable_name") != "probability_of_default"
    return lake.read("gold", "drift_metrics").select(
        "variable_name",
        F.when(known, F.round(psi, 6)).alias("psi_value"),
        F.when(known, F.col("drift_status")).alias("drift_status"),
        F.when(known, F.col("alert_triggered")).alias("alert_triggered"),
        (known | (psi >= 0) & (F.col("drift_status") == policy.drift_status(psi)) & (F.col("alert_triggered") == policy.drift_alert(psi))).alias("class_fits"),
        tracked.scalar().alias("tracked_rows"),
    )


@query
def drift_overall_alert(spark, sf_dir):
    return drift.overall_alert(_week(spark, sf_dir, demo.DRIFTED_WEEK))


@query
def drift_run_metrics(spark, sf_dir):
    rows = drift_rows(_week(spark, sf_dir, demo.DRIFTED_WEEK), "drifted-week")
    return _r6(rows, "number")


@query
def dialogue_scores(spark, sf_dir):
    lake = lake_at(spark, "dialogues")
    log_dialogues(lake, demo.dialogue_logs(spark, sf_dir))
    return _r6(lake.read("gold", "dialogue_logs").drop("log_date"), "toxicity_score")


@query
def large_lexicon_toxicity(spark, sf_dir):
    """Every turn of every conversation against a lexicon of all words of 4 to 20 characters of the documents."""
    word = F.explode(F.split(F.lower("text"), " ")).alias("word")
    words = demo.table(spark, sf_dir, "documents").select(word).where(F.length("word").between(4, 20))
    scored = with_toxicity(demo.table(spark, sf_dir, "conversations"), ["conv_id", "turn"], "text", words)
    return _r6(scored.select("conv_id", "turn", "toxicity_score"), "toxicity_score")


@query
def lexicon_words_found(spark, sf_dir):
    """How many conversation turns hold each word of the documents that any holds."""
    word = F.explode(F.split(F.lower("text"), " ")).alias("word")
    words = demo.table(spark, sf_dir, "documents").select(word).where(F.length("word").between(4, 20))
    turns = demo.table(spark, sf_dir, "conversations")
    found = lexicon_matches(turns, ["conv_id", "turn"], "text", words)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("turns"))


@query
def dialogue_safety_summary(spark, sf_dir):
    return _r6(safety_summary(demo.dialogue_logs(spark, sf_dir)), "avg_value", "rate_value")


# --- Streams ----------------------------------------------------------------------------
@query
def stream_silver_users(spark, sf_dir):
    """CSV files to Bronze to Silver, both as streams, in two rounds of files."""
    lake, folder = lake_at(spark, "stream"), scratch_path(spark, "stream-files")
    users = demo.bronze_users(spark, sf_dir)
    late = F.coalesce(F.col("country") > "NATION_2", F.lit(False))
    for part in (late, ~late):
        users.where(part).write.mode("append").option("header", True).csv(folder)
        stream_to_bronze(lake, "users", folder, f"{lake.root}/checkpoints/bronze").awaitTermination()
        stream_to_silver(lake, "users", f"{lake.root}/checkpoints/silver").awaitTermination()
    return lake.read("silver", "users")


@query
def stream_json_bronze(spark, sf_dir):
    """Two folders of JSON lines, each with its own stream, into one Bronze table."""
    lake = lake_at(spark, "stream-json")
    loans = demo.bronze_loans(spark, sf_dir)
    early = F.coalesce(F.col("updated_at") < "1998-01-01", F.lit(False))
    for name, part in (("early", early), ("late", ~early)):
        folder = scratch_path(spark, f"stream-json-{name}")
        loans.where(part).write.json(folder)
        stream_to_bronze(lake, "loans", folder, f"{lake.root}/checkpoints/{name}", "json").awaitTermination()
    return lake.read("bronze", "loans")


def _event_stream(spark, sf_dir):
    events = demo.table(spark, sf_dir, "events")
    return spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_prediction_log(spark, sf_dir):
    """Every valid request of the stream answered by the fallback and logged once."""
    e = F.col("event_id")
    requests = _event_stream(spark, sf_dir).select(
        F.concat(F.lit("p"), e.cast("string")).alias("prediction_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("value") * 40.0).alias("monthly_volume"),
        (e * 7 % 33).cast("int").alias("session_regularity"),
        (F.col("value") * 100.0).alias("income"),
        F.col("value").alias("latency_ms"),
    )
    lake = lake_at(spark, "stream-predictions")
    stream_predictions(lake, requests, None, f"{lake.root}/checkpoints/log").awaitTermination()
    logs = lake.read("gold", "prediction_logs").drop("log_date")
    return _r6(logs, "monthly_volume", "income")


@query
def stream_late_requests(spark, sf_dir):
    """Two rounds of requests, the second one days older than the first: all are logged."""
    e, folder = F.col("event_id"), scratch_path(spark, "late-files")
    requests = demo.table(spark, sf_dir, "events").select(
        F.concat(F.lit("p"), e).alias("prediction_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("value") * 40.0).alias("monthly_volume"),
        (e % 31).cast("int").alias("session_regularity"),
        (F.col("value") * 100.0).alias("income"),
        F.col("value").alias("latency_ms"),
    )
    lake = lake_at(spark, "late")
    old = F.col("timestamp") < F.lit(demo.BASELINE_UNTIL).cast("timestamp_ntz")
    for part in (~old, old):
        requests.where(part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(requests.schema).parquet(folder)
        stream_predictions(lake, stream, None, f"{lake.root}/checkpoints/late").awaitTermination()
    return lake.read("gold", "prediction_logs").select("prediction_id", "timestamp", "log_date", "status")


def _event_requests(events: DataFrame) -> DataFrame:
    """A valid scoring request for each event."""
    e = F.col("event_id")
    return events.select(
        F.concat(F.lit("p"), e.cast("string")).alias("prediction_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("value") * 40.0).alias("monthly_volume"),
        (e * 7 % 31).cast("int").alias("session_regularity"),
        (F.col("value") * 100.0).alias("income"),
        F.col("value").alias("latency_ms"),
    )


@query
def stream_repeated_ids(spark, sf_dir):
    """Two thirds of the requests logged in batch, then all sent again, two days on, as a stream, and
    once more, four days on, in batch: every id is logged once, on its first day."""
    lake, folder = lake_at(spark, "repeated-ids"), scratch_path(spark, "repeated-files")
    requests = _event_requests(demo.table(spark, sf_dir, "events"))
    first = F.substring("prediction_id", 2, 20).cast("bigint") % 3 != 0
    later = lambda days: requests.withColumn("timestamp", F.timestamp_add("DAY", F.lit(days), F.col("timestamp")))
    scoring.score_batch(lake, requests.where(first), None)
    later(2).write.parquet(folder)
    stream = spark.readStream.schema(requests.schema).parquet(folder)
    stream_predictions(lake, stream, None, f"{lake.root}/checkpoints/again").awaitTermination()
    scoring.score_batch(lake, later(4), None)
    return lake.read("gold", "prediction_logs").select("prediction_id", "timestamp", "log_date", "status")


def _current(spark, result: DataFrame, keys: list[str], label: str) -> ReplacingTable:
    """A stream of rows with ``day`` and ``last_at`` run into a table until its source is used up."""
    path = scratch_path(spark, label)
    table = ReplacingTable(spark, f"{path}/table", result.schema, keys)
    keep_current(result, table, f"{path}/checkpoint").awaitTermination()
    return table


@query
def stream_latency_windows(spark, sf_dir):
    """All windows, from the stream alone: those still open at its end are not final."""
    windows = latency_windows(_event_stream(spark, sf_dir), "event_type", "ts", "value")
    table = _current(spark, windows, ["event_type", "window_start"], "latency")
    return _r6(table.read(WINDOW_END, "2 MINUTES").drop("is_final"), "mean_latency")


#: The end of a latency window, and of a week, as instants.
WINDOW_END = "to_timestamp(concat(CAST(window_end AS STRING), 'Z'))"
WEEK_END = "to_timestamp(concat(CAST(week AS STRING), 'Z')) + INTERVAL 7 DAYS"


@query
def stream_final_windows(spark, sf_dir):
    """The windows that two minutes of lateness cannot change any more."""
    windows = latency_windows(_event_stream(spark, sf_dir), "event_type", "ts", "value")
    table = _current(spark, windows, ["event_type", "window_start"], "final")
    rows = table.read(WINDOW_END, "2 MINUTES")
    return rows.groupBy("event_type").agg(
        F.count_if("is_final").alias("final_windows"),
        F.count_if(~F.col("is_final")).alias("open_windows"),
        F.max(F.when(F.col("is_final"), F.col("window_end"))).alias("last_final"),
    )


@query
def stream_rolling_latency(spark, sf_dir):
    """The trailing mean at every instant, from six rounds of files: a fifth of the last hour before a round's
    end comes in the next one, and a seventh of its last half hour comes twice."""
    path = scratch_path(spark, "trailing")
    events = demo.table(spark, sf_dir, "events").withColumn("id", F.concat(F.lit("e"), F.monotonically_increasing_id()))
    events = written(events, "trailing-events")
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", first, F.col("ts"))
    length = 5 * 86_400
    left = F.lit(length) - F.pmod(seconds, F.lit(length))
    e = F.col("event_id")
    late = (left <= 3_600) & (e % 5 == 0)
    twice = (left <= 1_800) & (e % 7 == 0) & ~late
    own = F.floor(seconds / length)
    rounds = F.when(late, F.array(own + 1)).when(twice, F.array(own, own + 1)).otherwise(F.array(own))
    sent = events.select("*", F.explode(rounds).alias("round"))
    numbers = sorted(r[0] for r in sent.select("round").distinct().collect())
    stream = spark.readStream.schema(events.schema).parquet(f"{path}/files/*")
    rows = trailing_latency(stream, "event_type", "id", "ts", "value", delay="2 hours", blocks=60)
    table = ReplacingTable(spark, f"{path}/table", rows.schema, ["event_type", "ts"])
    for number in numbers:
        sent.where(F.col("round") == number).drop("round").write.parquet(f"{path}/files/{number}")
        keep_current(rows, table, f"{path}/checkpoint").awaitTermination()
    ends = "to_timestamp(concat(CAST(ts AS STRING), 'Z'))"
    return _r6(table.read(ends, "2 HOURS").drop("is_final"), "rolling_mean")


@query
def stream_weekly_psi(spark, sf_dir):
    """Weeks of the event stream, the last one as far as it goes, against the first deciles."""
    events = demo.table(spark, sf_dir, "events")
    until = F.lit(demo.BASELINE_UNTIL).cast("timestamp_ntz")
    baseline = long_form(events.where(F.col("ts") < until), ["value"])
    edges = written(bin_edges(baseline), "edges")
    counts = weekly_bin_counts(_event_stream(spark, sf_dir), edges, ["value"], "ts")
    table = _current(spark, counts, ["week", "variable", "bin"], "bins")
    expected = bin_counts(edges, expected=baseline)
    return _r6(weekly_psi(table.read(WEEK_END, "1 HOUR").drop("is_final"), expected), "psi")
