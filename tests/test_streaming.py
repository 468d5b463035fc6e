import json
import os

from loans_fixture import RAW
from pyspark.sql import functions as F

from ledgerlark.functions.clock import utc_instant, utc_wall
from ledgerlark.plans import training
from ledgerlark.plans.scoring import score, valid_requests
from ledgerlark.plans.silver import to_silver
from ledgerlark.schemas import BRONZE
from ledgerlark.session import scratch_root
from ledgerlark.sources.raw import from_records
from ledgerlark.streaming.layers import stream_to_bronze, stream_to_silver
from ledgerlark.streaming.monitoring import stream_predictions


def rows_of(lake, layer, table):
    return sorted(lake.read(layer, table).collect(), key=str)


def test_files_to_bronze_to_silver(spark, lake, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()

    def arrive(name, records):
        names = BRONZE["loans"].fieldNames()
        lines = [",".join("" if r[n] is None else r[n] for n in names) for r in records]
        (incoming / name).write_text("\n".join([",".join(names), *lines]) + "\n")
        stream_to_bronze(lake, "loans", str(incoming), str(tmp_path / "c1")).awaitTermination()
        stream_to_silver(lake, "loans", str(tmp_path / "c2")).awaitTermination()

    newer, older = RAW["loans"][3], RAW["loans"][2]
    arrive("one.csv", [newer, RAW["loans"][0]])
    arrive("two.csv", [older])  # an older version arriving late does not win
    assert {r.loan_id: r.amount for r in rows_of(lake, "silver", "loans")} == {"b1": 1250.0, "a1": 700.25}
    assert len(rows_of(lake, "bronze", "loans")) == 3
    arrive("three.csv", [])  # nothing new
    assert len(rows_of(lake, "bronze", "loans")) == 3


def test_streams_of_one_table_do_not_meet(spark, lake, tmp_path):
    for n, folder in enumerate(("first", "second")):
        (tmp_path / folder).mkdir()
        lines = [json.dumps(r) for r in RAW["loans"][4 * n : 4 * n + 4]]
        (tmp_path / folder / "loans.json").write_text("\n".join(lines))
        stream_to_bronze(lake, "loans", str(tmp_path / folder), str(tmp_path / f"check-{folder}"), "json").awaitTermination()
    assert len(rows_of(lake, "bronze", "loans")) == 8
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "loans.json").write_text(json.dumps(RAW["loans"][8:10], indent=1))
    stream_to_bronze(lake, "loans", str(tmp_path / "array"), str(tmp_path / "check-array"), "json", json_form="array").awaitTermination()
    assert len(rows_of(lake, "bronze", "loans")) == 10


def test_streamed_csv_with_quotes_and_another_delimiter(spark, lake, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('user_id;created_at;country;updated_at;ingestion_timestamp\n1;;"a\n""b""";;\n')
    stream_to_bronze(lake, "users", str(tmp_path / "in"), str(tmp_path / "c"), multi_line=True).awaitTermination()
    assert [(r.user_id, r.country) for r in rows_of(lake, "bronze", "users")] == [("1", 'a\n"b"')]


def test_repeated_load_replaces_itself(spark, lake):
    users = from_records(spark, RAW["users"], "users")
    for _ in range(2):
        lake.add_load("users", users, "stream-0")
    lake.add_load("users", users, "stream-1")
    assert lake.read("bronze", "users").count() == 2 * len(RAW["users"])


def test_utc_times_do_not_depend_on_the_session_zone(spark):
    # 02:30 that night does not exist in New York.
    df = spark.createDataFrame([("2023-03-12 02:30:00.123456",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select("t", utc_wall(utc_instant(F.col("t"))).alias("back"), F.unix_micros(utc_instant(F.col("t"))).alias("us")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.t == row.back and row.us == 1678588200123456


def test_scored_stream_logs_each_request_once(spark, lake, tmp_path):
    users = spark.range(40).select(
        F.concat(F.lit("u"), F.col("id")).alias("user_id"),
        (F.col("id") * 500.0).alias("monthly_volume"),
        (F.col("id") % 40).cast("int").alias("session_regularity"),
        (F.col("id") * 1000.0).alias("income"),
        (F.col("id") < 10).cast("int").alias("label"),
    )
    model = training.fit(users, label="label", maxIter=3, maxDepth=2)
    requests = users.select(
        F.concat(F.lit("p"), F.substring("user_id", 2, 9)).alias("prediction_id"),
        F.lit("2023-08-10 12:00:00").cast("timestamp_ntz").alias("timestamp"),
        "user_id", "monthly_volume", "session_regularity", "income", F.lit(9.0).alias("latency_ms"),
    )
    folder = str(tmp_path / "requests")
    for _ in range(2):  # the second round repeats every request
        requests.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(requests.schema).parquet(folder)
        stream_predictions(lake, stream, model, str(tmp_path / "c")).awaitTermination()
    logged = {r.prediction_id: r for r in lake.read("gold", "prediction_logs").collect()}
    assert len(logged) == 31 == lake.read("gold", "prediction_logs").count()  # 30 days at most
    batch = {r.prediction_id: r for r in score(valid_requests(requests), model).collect()}
    for key, row in logged.items():
        assert row.probability_of_default == batch[key].probability_of_default
        assert (row.decision, row.status, row.is_anomaly) == (batch[key].decision, "SUCCESS", False)


def test_flows_leave_no_scratch_behind(spark, lake):
    root = scratch_root(spark) + "/ledgerlark"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    lake.upsert_silver({"users": to_silver(from_records(spark, RAW["users"], "users"), "users")})
    assert set(os.listdir(root)) == before
