"""Array files of the JSON ingest."""

import json

import registered
from ledgerlark.sources import demo
from ledgerlark.sources.raw import read_json

SF_DIR = "/root/testdata/sf0.001"


def test_array_files_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registered, "scratch_path", lambda _, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(registered, "ARRAY_ROWS", 10, raising=False)
    rows = registered.QUERIES["json_array_ingest"](spark, SF_DIR).count()
    arrays = [json.loads(f.read_text()) for f in (tmp_path / "array-files/users.json").glob("part-*")]
    assert rows == demo.bronze_users(spark, SF_DIR).count() == sum(map(len, arrays))
    assert len(arrays) > rows / 20 and max(map(len, arrays)) < rows / 2


def test_no_rows_are_no_arrays(spark, tmp_path):
    registered.write_arrays(demo.bronze_users(spark, SF_DIR).limit(0), f"{tmp_path}/users.json")
    assert read_json(spark, f"{tmp_path}/users.json", "users").count() == 0
