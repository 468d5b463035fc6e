import json

import pytest
from loans_fixture import AS_OF, OBSERVED, RAW
from pyspark.sql import functions as F

from ledgerlark.operators.audit import audit_long, audit_warnings, audit_wide
from ledgerlark.plans import cohorts, gold, medallion
from ledgerlark.plans.silver import all_silver, to_silver
from ledgerlark.sources.lake import Lake
from ledgerlark.sources.raw import delimiter_of, from_records, load_bronze


@pytest.fixture
def bronze(spark):
    return {t: from_records(spark, rows, t) for t, rows in RAW.items()}


@pytest.fixture
def silver(bronze):
    return all_silver(bronze)


def keyed(df, key):
    return {r[key]: r for r in df.collect()}


def test_silver_keeps_newest_valid_rows(silver):
    users = keyed(silver["users"], "user_id")
    assert set(users) == {"ana", "bruno", "carla", "dario"}
    assert users["ana"].country == "PE"
    assert str(users["carla"].created_at) == "2023-01-15 07:45:00"
    assert users["dario"].created_at is None  # day first with slashes
    assert set(keyed(silver["user_sessions"], "session_id")) == {f"s{i}" for i in range(1, 9)}
    loans = keyed(silver["loans"], "loan_id")
    assert set(loans) == {"a1", "a2", "b1", "c1"}  # d3's newest version is malformed
    assert loans["b1"].amount == 1250.0 and str(loans["b1"].disbursement_date) == "2023-07-01"
    assert loans["c1"].term_months == 13 and str(loans["c1"].disbursement_date) == "2023-06-01"
    payments = keyed(silver["loan_payments"], "payment_id")
    assert set(payments) == {"p1", "p2", "p3", "p4", "p5", "p6", "p7", "p9"}
    assert str(payments["p9"].payment_date) == "2023-10-02"


def test_gold_windows_and_default_rule(silver):
    rows = keyed(gold.gold_rows(silver, OBSERVED, AS_OF), "user_id")
    features = {
        u: (r.monthly_volume, r.session_regularity, r.target_default_30d) for u, r in rows.items()
    }
    # ana: 30 days late is no default; day -30 and the day itself count, day +1 does not.
    # bruno: 31 days late although nearly nothing was paid. carla: due on the last day of the
    # 12 months and never paid; the payment due a day later does not matter.
    assert features == {
        "ana": (700.25, 3, 0),
        "bruno": (1250.0, 1, 1),
        "carla": (300.5, 0, 1),
        "dario": (0.0, 0, 0),
    }
    early = keyed(gold.gold_rows(silver, OBSERVED, "2024-07-31"), "user_id")
    assert early["carla"].target_default_30d == 0  # 30 days overdue as of then


def test_result_does_not_depend_on_partitioning(bronze):
    def rows(n):
        spread = {t: df.repartition(n) for t, df in bronze.items()}
        return sorted(map(tuple, gold.gold_rows(all_silver(spread), OBSERVED, AS_OF).collect()))

    assert rows(1) == rows(7)


def test_audit(bronze):
    expected = {
        "users_null_pk": 1, "users_duplicate_pk": 1, "users_invalid_timestamps": 2,
        "sessions_null_pk": 2, "sessions_invalid_timestamp": 2,
        "loans_null_pk": 2, "loans_duplicate_pk": 2, "loans_invalid_disbursement_date": 1,
        "loans_invalid_amount": 2,
        "payments_null_pk": 1, "payments_duplicate_pk": 1, "payments_invalid_due_date": 1,
        "payments_invalid_payment_date": 1, "payments_invalid_amounts": 1,
    }
    assert {r["check"]: r.anomalies for r in audit_long(bronze).collect()} == expected
    assert audit_wide(bronze).first().asDict() == expected
    assert audit_warnings(bronze).count() == len(expected)


def test_audit_of_clean_and_empty_tables(spark):
    empty = {t: from_records(spark, [], t) for t in RAW}
    assert set(audit_wide(empty).first()) == {0}
    assert audit_warnings(empty).count() == 0


def test_whole_flow_and_second_run(lake):
    first = medallion.run_pipeline(lake, OBSERVED, RAW, AS_OF)
    assert first["ingest_summary"] == {t: len(r) for t, r in RAW.items()}
    assert first["silver_summary"] == {
        "users": 4, "user_sessions": 8, "loans": 4, "loan_payments": 8,
    }
    assert first["gold_summary"] == {"inserted_count": 4}
    rates = {r["reg_month"]: (r["default_rate"], r["cohort_size"]) for r in first["alerts_summary"]}
    assert rates == {"2022-11": (0.5, 2), "2023-01": (1.0, 1), None: (0.0, 1)}
    report = first["drift_report"]
    assert "2023-01 | **Default Rate**: 100.00% | **Cohort Size**: 1 users" in report
    assert "2022-11 | **Default Rate**: 50.00%" in report and "None" not in report

    stored = sorted(map(tuple, lake.read("gold", "target_construction").collect()))
    second = medallion.run_pipeline(lake, OBSERVED, RAW, AS_OF)
    assert second["silver_summary"] == first["silver_summary"]
    assert sorted(map(tuple, lake.read("gold", "target_construction").collect())) == stored
    counts = {(r.layer, r.table): r.rows for r in lake.row_counts(["bronze", "gold"]).collect()}
    assert counts[("bronze", "loans")] == 2 * len(RAW["loans"])
    assert counts[("gold", "target_construction")] == 4


def test_no_alert_no_report(spark):
    rates = spark.createDataFrame([("2023-01", 0.15, 20)], "reg_month string, default_rate double, cohort_size long")
    assert cohorts.cohort_alerts(rates).count() == 0  # exactly 15 % is no alert
    assert cohorts.cohort_report(rates, OBSERVED).first().drift_report is None


def test_silver_depends_on_history(spark, lake):
    """A stored valid loan survives a later malformed version; a new valid one replaces it."""
    def load(amount, day):
        rows = [dict(RAW["loans"][0], loan_id="h", amount=amount, updated_at=f"2023-06-{day} 00:00:00")]
        lake.upsert_silver({"loans": to_silver(from_records(spark, rows, "loans"), "loans")})
        return lake.read("silver", "loans").where("loan_id = 'h'").first().amount

    assert load("10", "01") == 10.0
    assert load("oops", "02") == 10.0
    assert load("30", "03") == 30.0


def test_upsert_leaves_other_rows_and_buckets(spark, lake):
    def users(names, country):
        rows = [dict(RAW["users"][0], user_id=n, country=country) for n in names]
        return to_silver(from_records(spark, rows, "users"), "users")

    lake.upsert_silver({"users": users([f"u{i}" for i in range(50)], "old")})
    lake.upsert_silver({"users": users(["u7", "u8", "new"], "new")})
    stored = keyed(lake.read("silver", "users"), "user_id")
    assert len(stored) == 51
    assert {u for u, r in stored.items() if r.country == "new"} == {"u7", "u8", "new"}


def test_gold_merge_keeps_other_dates_and_users(lake, silver):
    rows = gold.gold_rows(silver, OBSERVED, AS_OF)
    lake.merge_gold(gold.gold_rows(silver, "2023-06-01", AS_OF), "2023-06-01")
    lake.merge_gold(rows, OBSERVED)
    changed = rows.where("user_id = 'ana'").withColumn("monthly_volume", F.lit(5.0))
    assert lake.merge_gold(changed, OBSERVED) == 1
    with pytest.raises(Exception, match="is not of"):
        lake.merge_gold(rows, "2023-06-01")
    table = lake.read("gold", "target_construction")
    assert table.count() == 8
    now = keyed(table.where(F.col("observation_date") == F.lit(OBSERVED).cast("date")), "user_id")
    assert now["ana"].monthly_volume == 5.0 and now["bruno"].monthly_volume == 1250.0


def test_csv_and_json_sources(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    names = list(RAW["users"][0])
    lines = [";".join("" if r[n] is None else r[n] for n in names) for r in RAW["users"]]
    # Columns bind by position: the header's names do not matter.
    (folder / "users.csv").write_text("\n".join([";".join("abcde"), *lines]) + "\n")
    records = [dict(r, extra=1) for r in RAW["loans"]]
    records[0].pop("term_months")
    records[1]["amount"] = 90
    (folder / "loans.json").write_text(json.dumps(records))
    (folder / "loans.csv").write_text("ignored\n")
    counts = load_bronze(lake, str(folder))
    assert counts == {"users": 6, "user_sessions": 0, "loans": 11, "loan_payments": 0}
    got = sorted(lake.read("bronze", "users").collect(), key=str)
    assert got == sorted(from_records(spark, RAW["users"], "users").collect(), key=str)
    loans = lake.read("bronze", "loans").where("loan_id in ('a1', 'a2')").orderBy("loan_id").collect()
    assert loans[0].term_months is None and loans[1].amount == "90"


def test_bad_sources(lake):
    with pytest.raises(ValueError):
        load_bronze(lake, 5)
    with pytest.raises(ValueError):
        load_bronze(lake, "/no/such/folder")
    assert load_bronze(lake, {}) == {t: 0 for t in RAW}


def test_delimiters():
    assert delimiter_of("a,b,c", 3) == ","
    assert delimiter_of("a\tb\tc", 3) == "\t"
    assert delimiter_of("a|b", 2) == "|"


def test_create_is_repeatable_and_guards_buckets(spark, lake):
    lake.create()
    assert lake.read("silver", "users").count() == 0
    with pytest.raises(ValueError):
        Lake(spark, lake.root, buckets=8).create()
    lake.register_views()
    assert spark.sql("SELECT count(*) FROM gold_target_construction").first()[0] == 0


def test_infinite_amounts_sum_like_doubles(spark):
    loans = spark.createDataFrame(
        [("u", "2023-06-20", float("inf")), ("u", "2023-06-20", 1.0), ("v", "2023-06-20", 0.1),
         ("v", "2023-06-20", 0.2)],
        "user_id string, d string, amount double",
    ).withColumn("disbursement_date", F.col("d").cast("date"))
    sums = keyed(gold.monthly_volume(loans, OBSERVED), "user_id")
    assert sums["u"].monthly_volume == float("inf") and sums["v"].monthly_volume == pytest.approx(0.3)


def test_forms_are_told_apart_and_bad_files_fail(spark, lake, tmp_path):
    records = RAW["loans"][:5]
    lines = "\n".join(json.dumps(r) for r in records)
    for form, good, bad in (("lines", lines, json.dumps(records, indent=2)), ("array", json.dumps(records, indent=2), lines)):
        for name, text in (("good", good), ("bad", bad)):
            folder = tmp_path / f"{form}-{name}"
            folder.mkdir()
            (folder / "loans.json").write_text(text)
        assert load_bronze(lake, str(tmp_path / f"{form}-good"), json_form=form)["loans"] == 5
        with pytest.raises(Exception):
            load_bronze(lake, str(tmp_path / f"{form}-bad"), json_form=form)


def test_quoted_line_breaks(spark, lake, tmp_path):
    names = ["user_id", "created_at", "country", "updated_at", "ingestion_timestamp"]
    (tmp_path / "users.csv").write_text(",".join(names) + '\n1,,"a ""b""\nc, d",,\n2,,x,,\n')
    assert load_bronze(lake, str(tmp_path), multi_line=True)["users"] == 2
    got = {r.user_id: r.country for r in lake.read("bronze", "users").collect()}
    assert got == {"1": 'a "b"\nc, d', "2": "x"}
    (tmp_path / "users.csv").write_text(",".join(names) + "\n1,,x,,,too,many\n")
    with pytest.raises(Exception):
        load_bronze(lake, str(tmp_path))


def test_tiny_amounts_are_not_cut(spark):
    loans = spark.createDataFrame([("u", 4e-9), ("u", 4e-9), ("v", 1e25), ("v", 0.5)], "user_id string, amount double")
    loans = loans.withColumn("disbursement_date", F.lit(OBSERVED).cast("date"))
    got = {r.user_id: r.monthly_volume for r in gold.monthly_volume(loans, OBSERVED).collect()}
    assert got == {"u": 8e-9, "v": 1e25}


def test_first_load_is_moved_and_others_are_swapped_in(spark, lake, monkeypatch):
    """New buckets are not copied; a load for stored buckets is, also where their rows are gone."""
    swaps, swap = [], lake._swap
    monkeypatch.setattr(lake, "_swap", lambda layer, table, *rest: (swaps.append(table), swap(layer, table, *rest)))

    def load(names, updated):
        rows = [dict(RAW["loans"][0], loan_id=n, updated_at=f"2023-06-{updated} 00:00:00") for n in names]
        lake.upsert_silver({"loans": to_silver(from_records(spark, rows, "loans"), "loans")}, keep_newer=True)
        return sorted(r.loan_id for r in lake.read("silver", "loans").collect())

    names = [f"l{i:02}" for i in range(40)]
    assert load(names, "01") == names and swaps == []
    assert load([*names, "new"], "02") == [*names, "new"] and swaps == ["loans"]
    swap("silver", "loans", lake._stored("silver", "loans").limit(0), "bucket")
    lake._stored("silver", "loans").limit(0).write.mode("overwrite").parquet(lake.path("silver", "loans") + "/bucket=0")
    assert load(["x", "y", "z"], "03")[-3:] == ["x", "y", "z"]
