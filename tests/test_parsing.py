"""Tolerant parsing agrees with the SQL casts it stands for, on many spellings."""

import duckdb
import pytest
from pyspark.sql import functions as F

import oracle_sql
from ledgerlark.functions import parsing

TIMES = """2024-12-20|2024-12-20 10:11:12|2024-12-20T10:11:12|2024/12/20 10:11:12|2024/12/20
20-12-2024 10:11:12|20/12/2024 10:11:12|20-12-2024|1-2-2024 3:4:5|2024-1-2 3:4:5|2024-1-2
2024-12-20 10:11|2024-12-20 10|2024-12|2024|2024-13-01|2024-02-30|2023-02-29|2024-02-29
2024-12-20 25:00:00|2024-12-20 10:61:00|2024-12-20 10:11:12.5|2024-12-20 10:11:12.123456
2024-12-20 10:11:12Z|2024-12-20 10:11:12+02:00|2024-12-20 10:11:12-0530|31-04-2024 00:00:00
invalid-date||n/a|20-13-2024 00:00:00|20-12-2024 10:11|20-12-2024 10:11:12.5|20-12-24 10:11:12
20241220|2024-12-20x|x2024-12-20|32-01-2024|29-02-2023|29-02-2024|0-1-2024
20-12-24|5-1-1|123-1-1|12024-01-01|123456-01-01| 2024-01-01 |2024-01-01 00:00:00 | 20-12-2024 10:11:12
20-12-2024  10:11:12|20-12-2024 10:11:12 |1-1-24 10:11:12|2024-001-01|2024-01-01T|20-12-2024 24:00:00""".replace("\n", "|")
NUMBERS = """1|1.5|-2.25|+3|.5|5.|1e3|1E-2|1.0d|1f|0x10|abc||n/a|1,000|12 | 12|-0.0
12.5|13.5|-2.5|99999999999|1e400|--1|1.2.3|e5|inf|-Infinity|nan""".replace("\n", "|")


def compare(spark, values, spark_expr, sql_expr):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r[0] for r in df.select(spark_expr(F.col("c")).cast("string")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, c VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    want = [r[0] for r in con.execute(f"SELECT {sql_expr} FROM t ORDER BY i").fetchall()]
    got = [g and g.lstrip("+") for g in got]  # printed before years of five digits
    return {v: (g, w) for v, g, w in zip(values, got, want) if g != w}


@pytest.mark.parametrize(
    "parse,sql",
    [
        (parsing.parse_timestamp, oracle_sql.ts("c")),
        (parsing.iso_timestamp, oracle_sql.ts_iso("c")),
        (parsing.parse_date, oracle_sql.date("c")),
    ],
    ids=["timestamp", "iso", "date"],
)
def test_times_like_sql(spark, parse, sql):
    assert compare(spark, TIMES.split("|"), parse, f"CAST({sql} AS VARCHAR)") == {}


def test_numbers_like_sql(spark):
    df = spark.createDataFrame([(v,) for v in NUMBERS.split("|")], "c string")
    rows = df.select(
        "c", parsing.parse_double(F.col("c")).alias("d"), parsing.parse_int(F.col("c")).alias("i")
    ).collect()
    con = duckdb.connect()
    known = {"0x10"}  # the SQL engine also reads hexadecimal integers
    for row in rows:
        d, i = con.execute("SELECT TRY_CAST(? AS DOUBLE), TRY_CAST(? AS INTEGER)", [row.c] * 2).fetchone()
        assert repr(row.d) == repr(d), row.c
        if row.c not in known and not (d is not None and (d != d or "e" in row.c.lower())):
            assert row.i == i, row.c


def test_slashes_only_year_first(spark):
    df = spark.createDataFrame([("15/05/2024 10:00:00", "2024/05/15 10:00:00")], "a string, b string")
    row = df.select(*[parsing.parse_timestamp(F.col(c)) for c in "ab"]).first()
    assert row[0] is None and str(row[1]) == "2024-05-15 10:00:00"


def test_usual_spellings_meet_two_patterns_at_most(spark):
    """One pattern tells and swaps a day-first text; the usual spelling alone is part of the general one."""
    text = spark.createDataFrame([("x",)], "c string").select(parsing.parse_timestamp(F.col("c")).alias("t"))
    own = text._jdf.queryExecution().analyzed().toString()
    assert own.count("RLIKE") == 2 and own.count("regexp_replace") == 1


@pytest.mark.parametrize(
    "text", ["--", "- ", "1--2", "2024-12", "x\n20-12-2024", "20-12-2024 1:2:3\n20-12-2024 1:2:3", "", "\n", "$1-$2"]
)
def test_what_is_not_day_first_is_no_date(spark, text):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(*[p(F.col("c")) for p in (parsing.parse_timestamp, parsing.parse_date)]).first()[:] == (None, None)
