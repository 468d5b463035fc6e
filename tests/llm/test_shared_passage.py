"""Substring dedup where one passage stands in every text, more often than one row of places can hold."""

from ledgerlark.llm import substrings
from tests.llm.fixture import DOCS, by_row, prose
from tests.llm.test_text_operators import repeated


def test_one_passage_in_every_text(spark):
    passage, count = prose(1, 45), substrings.PLACES + 300
    rows = [(i, f"{prose(10 + i, 6)} {passage} {prose(9_000 + i, 4)}", "", "", "", 0, 0) for i in range(count)]
    rows += [(count + i, passage, "", "", "", 0, 0) for i in range(50)] + [(count + 50, prose(3, 60), "", "", "", 0, 0)]
    got = substrings.dedup_substrings(spark.createDataFrame(rows, DOCS).coalesce(1), digest_only=True).collect()
    assert by_row(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == repeated(rows, 35)
    assert sum(r["n_removed"] >= 45 for r in got) == count + 50


def test_places_are_never_a_row_each(spark, monkeypatch):
    """Near copies in many tasks: a text's marks come from its lot, one row for each text."""
    plans, inner = {}, substrings.written

    def noted(df, label, *more):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return inner(df, label, *more)

    monkeypatch.setattr(substrings, "written", noted)
    base = prose(5, 200).split()
    rows = [(i, " ".join([*base[: 20 + i], f"own{i}", *base[20 + i :]]), "", "", "", 0, 0) for i in range(120)]
    rows += [(120, prose(6, 90), "", "", "", 0, 0), (121, None, "", "", "", 0, 0), (122, rows[0][1], "", "", "", 0, 0)]
    got = substrings.dedup_substrings(spark.createDataFrame(rows, DOCS).repartition(5), digest_only=True).collect()
    assert by_row(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == repeated(rows, 35)
    assert "Generate" not in plans["substring-marks"] and "FlatMapGroupsInArrow" in plans["substring-marks"]
