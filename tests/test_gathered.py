"""Feature sets and cleaning move the rows of an origin once, with the results of the split paths."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import clean, features
from millrace.operators.roles import Roles
from millrace.session import GROUP_ROWS_KEY

SCHEMA = """leg_id long, line int, origin long, dest long, day date, carrier string, hhmm int, cancelled int, late int,
    tail long, minutes double, distance double, wind double, temp double, sky string, humidity double, rain double"""
ORDER = ["day", "hhmm", "leg_id", "line"]


def _rows():
    rng = random.Random(5)
    some = lambda v, p=0.2: None if rng.random() < p else v
    rows = []
    for k in range(400):
        day = datetime.date(1995, 1, 1) + datetime.timedelta(days=rng.randrange(0, 90, 7))
        origin = some(rng.choice([1, 1, 1, 2, 3]), 0.1)
        late = some(rng.randrange(2), 0.1)
        rows.append((k, 1, origin, rng.randrange(3), day, rng.choice("FO"), rng.randrange(24) * 100 + 7, int(late is None), late,
                     some(rng.randrange(4)), float(rng.randrange(1, 50)), float(rng.randrange(900, 990)),
                     some(float(rng.randrange(40)), 0.5), some(rng.randrange(300) / 10, 0.5), some(rng.choice("ANR"), 0.5),
                     float(rng.randrange(90)), rng.randrange(50) / 10))
    return rows + rows[:40]


@pytest.fixture
def legs(spark, tmp_path):
    spark.createDataFrame(_rows(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/legs")
    return spark.read.parquet(f"{tmp_path}/legs")


SETS = {
    "place": lambda df: features.place_profile(df, Roles(), ORDER, "F"),
    "time": lambda df: features.time_profile(df, Roles(), ORDER),
    "reading": lambda df: features.reading_profile(df, Roles(), ORDER, "temp", "humidity", "wind", "rain", "minutes"),
    "carrier": lambda df: features.carrier_profile(features.clock_columns(df, Roles()), Roles(), ORDER, "F"),
    "all": lambda df: features.all_profiles(df, Roles(), ORDER, "F"),
    "clean": lambda df: clean.clean_pass(df, Roles(), ORDER, ["day", "hhmm"], ["wind", "temp"], "sky"),
}


def _moves(df):
    """Exchanges by key, and joins, of the plan."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    ready = df._jdf.queryExecution().executedPlan().toString()
    return ready.count("Exchange hashpartitioning"), plan.count("Join")


def _plain(df):
    show = lambda v: f"{0.0 if math.isclose(v, 0, abs_tol=1e-9) else v:.7g}" if isinstance(v, float) else str(v)
    return df.columns, sorted([show(v) for v in r] for r in df.collect())


@pytest.mark.parametrize("name", SETS)
def test_same_as_the_split_path(spark, legs, name):
    near = _plain(SETS[name](legs))
    spark.conf.set(GROUP_ROWS_KEY, "40")
    try:
        assert near == _plain(SETS[name](legs))
    finally:
        spark.conf.unset(GROUP_ROWS_KEY)


@pytest.mark.parametrize("name", ["place", "time", "reading"])
def test_sets_move_rows_once(legs, name):
    assert _moves(SETS[name](legs)) == (1, 0)


@pytest.mark.parametrize("name", ["carrier", "all"])
def test_only_the_tail_is_joined(spark, legs, name):
    assert _moves(SETS[name](legs)) == (1, 1)  # aircraft cross origins; their table is small


def test_cleaning_stages_full_rows_once(spark, legs, monkeypatch):
    full, stage = [], clean.stage
    monkeypatch.setattr(clean, "stage", lambda df: (full.append(df), stage(df))[1])
    assert SETS["clean"](legs).count() == legs.count()
    (rows,) = full
    assert _moves(rows) == (1, 0)
