"""An id is in a log once, whatever the day it is sent again on and wherever a run has died."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.sources import logs
from ledgerlark.sources.logs import compact_ids, finish_pending, log_dialogues, log_predictions, pending_folder

KIND = "prediction_id string, timestamp timestamp_ntz, user_id string, probability_of_default double"


def rows(spark, *pairs):
    return spark.createDataFrame([(i, day and dt.datetime(2024, 1, day, 12), "u", 0.1) for i, day in pairs], KIND)


def logged(lake, table="prediction_logs"):
    return sorted((r[0], r["timestamp"].day) for r in lake.read("gold", table).collect())


def test_an_id_sent_again_on_other_days_is_logged_once(spark, lake):
    log_predictions(lake, rows(spark, ("p1", 1), ("p2", 3)))
    for _ in range(2):
        log_predictions(lake, rows(spark, ("p1", 2), ("p2", 1), ("p3", 2)))
    assert logged(lake) == [("p1", 1), ("p2", 3), ("p3", 2)]


def test_a_batch_without_times_can_be_sent_again(spark, lake):
    for _ in range(2):
        log_predictions(lake, rows(spark, ("p1", None), ("p2", None)))
    assert [i for i, _ in logged(lake)] == ["p1", "p2"]


def test_dialogues_too(spark, lake):
    for day in (1, 5):
        log_dialogues(lake, rows(spark, ("d1", day)).withColumnRenamed("prediction_id", "dialogue_id"))
    assert logged(lake, "dialogue_logs") == [("d1", 1)]


@pytest.mark.parametrize("dies_in", ["log", "ids", "forget"])
def test_a_batch_that_died_is_finished(spark, lake, monkeypatch, dies_in):
    log_predictions(lake, rows(spark, ("p0", 1)))
    append, calls = lake.append, []

    def dying(layer, table, df):
        calls.append(table)
        if (table == "prediction_logs") == (dies_in == "log") and dies_in != "forget":
            raise OSError("gone")
        append(layer, table, df)

    def not_forgotten(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(lake, "append", dying)
        if dies_in == "forget":
            m.setattr(logs, "_forget", not_forgotten)
        with pytest.raises(OSError):
            log_predictions(lake, rows(spark, ("p1", 1), ("p2", 2)))
    log_predictions(lake, rows(spark, ("p2", 4), ("p3", 3)))
    assert logged(lake) == [("p0", 1), ("p1", 1), ("p2", 2), ("p3", 3)]
    ids = lake.read("gold", "prediction_log_keys").collect()
    assert sorted(r["id"] for r in ids) == ["p0", "p1", "p2", "p3"]


def test_half_a_pending_batch_is_given_up(spark, lake):
    path = f"{pending_folder(lake, 'prediction_logs')}/half"
    rows(spark, ("p9", 1)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(path)
    assert finish_pending(lake, "prediction_logs", "prediction_id") == 1
    assert logged(lake) == [] and finish_pending(lake, "prediction_logs", "prediction_id") == 0


def test_compacted_ids_stay_the_same(spark, lake):
    for day in range(1, 5):
        log_predictions(lake, rows(spark, *[(f"p{i}", day) for i in range(day * 10)]))
    before = sorted(map(tuple, lake.read("gold", "prediction_log_keys").collect()))
    compact_ids(lake, most_files=1)
    assert lake.compact("gold", "prediction_log_keys", 1) == []
    assert sorted(map(tuple, lake.read("gold", "prediction_log_keys").collect())) == before
    log_predictions(lake, rows(spark, ("p3", 9), ("new", 9)))
    assert lake.read("gold", "prediction_logs").agg(F.count("*"), F.count_distinct("prediction_id")).first()[:] == (41, 41)
