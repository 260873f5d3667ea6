"""The full cleaning pass takes all steps of the method."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import clean
from millrace.operators.roles import Roles
from millrace.plans import profiling
from millrace.session import GROUP_ROWS_KEY

SCHEMA = """leg_id long, origin long, dest long, day date, carrier string, hhmm int, arr int, cancelled int, late int, elapsed int,
    arr_block string, wind double, temp double, sky string, station long, equipped string, remark string"""
DAY = datetime.date(1995, 3, 4)
ROWS = [
    (1, 1, 2, DAY, "F", 950, 1010, 0, 1, None, None, 5.0, 1.0, "A", 7, None, None),
    (2, 1, 2, DAY, "F", 2350, 15, 0, 0, None, "given", None, None, None, 7, "1990-02-01", "kept"),
    (3, 1, 2, DAY, "F", 2355, 100, 1, None, 61, None, 9.0, 2.0, "B", 7, "1989-01-01", None),
    (4, 2, 2, DAY, "F", 1200, 1300, None, None, 60, None, 9.0, 2.0, "B", 8, None, None),  # no outcome, not known as cancelled
    (5, 2, 2, DAY, "F", 1200, None, 0, 1, 60, None, 9.0, 2.0, "B", 8, "1991-01-01", None),  # no arrival
    (6, 2, 2, DAY, "F", 1200, 1330, 0, 1, 45, None, 9.0, 2.0, "B", 8, None, None),
]


def _pass(df):
    return clean.clean_pass(
        df, Roles(), ["day", "hhmm", "leg_id"], ["day", "hhmm"], ["wind", "temp"], "sky",
        text=["remark"], arrival="arr", elapsed="elapsed", station="station", equipment=["equipped"],
    )


@pytest.mark.parametrize("rows", ["1000", "1"])
def test_all_steps(spark, rows):
    spark.conf.set(GROUP_ROWS_KEY, rows)
    try:
        got = {r["leg_id"]: r for r in _pass(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    finally:
        spark.conf.unset(GROUP_ROWS_KEY)
    assert sorted(got) == [1, 2, 3, 6]
    assert [got[k]["late"] for k in (1, 2, 3, 6)] == [1, 0, 2, 1]
    assert [got[k]["elapsed"] for k in (1, 2, 3, 6)] == [20, 25, 61, 45]
    assert [got[k]["dep_block"] for k in (1, 2, 3, 6)] == ["0900-1059", "2300-2459", "2300-2459", "1200-1359"]
    assert [got[k]["arr_block"] for k in (1, 2, 3, 6)] == ["1000-1159", "given", "0100-0259", "1300-1459"]
    assert [got[k]["equipped"] for k in (1, 2, 3, 6)] == ["1990-02-01", "1990-02-01", "1989-01-01", "UNKNOWN"]
    assert [got[k]["remark"] for k in (1, 2, 3, 6)] == ["UNKNOWN", "kept", "UNKNOWN", "UNKNOWN"]


def test_given_times_are_kept(spark):
    at = datetime.datetime(1995, 3, 4, 1, 2, 3)
    df = spark.createDataFrame(ROWS[:3], SCHEMA).withColumn("departs_at", F.when(F.col("leg_id") == 1, F.lit(at)))
    got = {r["leg_id"]: (r["departs_at"], r["two_hours_before"]) for r in _pass(df).collect()}
    assert got[1] == (at, datetime.datetime(1995, 3, 4, 7, 50))
    assert got[2] == (datetime.datetime(1995, 3, 4, 23, 50), datetime.datetime(1995, 3, 4, 21, 50))


def test_elapsed_needs_the_arrival(spark):
    with pytest.raises(ValueError, match="arrival"):
        clean.clean_pass(spark.createDataFrame(ROWS, SCHEMA), Roles(), ["day"], ["day"], ["wind"], "sky", elapsed="elapsed")


def test_query_takes_all_steps(spark):
    got = profiling.full_cleaning_pass(spark, "/root/testdata/sf0.001")
    assert got.filter(" OR ".join(f"{c} IS NULL" for c in got.columns if c != "tail")).isEmpty()
    whole = got.filter("floor(arr_hhmm / 100) BETWEEN 0 AND 23 AND arr_hhmm % 100 < 60 AND elapsed > 0 AND monthday = day(day) AND weekday = dayofweek(day)")
    assert whole.count() == got.count() > 0
    assert {"arr_block", "elapsed", "equipped", "remark", "year", "quarter", "month"} <= set(got.columns)
