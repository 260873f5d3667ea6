import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import maths
from millrace.operators import joins, keyed

T0 = dt.datetime(2024, 1, 1, 10, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def frames(spark, events, readings):
    e = spark.createDataFrame([(i, "s", t) for i, t in enumerate(events)], "id int, place string, due timestamp")
    r = spark.createDataFrame([(i, "s", t) for i, t in enumerate(readings)], "rid int, place string, taken timestamp")
    return e, r


def matches(df):
    return {(x.id, x.rid) for x in df.collect()}


def test_start_looks_into_one_hour_only(spark):
    # due 10:30: the interval is 06:30 to 08:30, its first hour ends at 07:00
    e, r = frames(spark, [at(30)], [at(-211), at(-210), at(-181), at(-180), at(-90), at(-89)])
    assert matches(joins.interval_join(e, r, ["place"], "due", "taken", bucket="start")) == {(0, 1), (0, 2)}
    assert matches(joins.interval_join(e, r, ["place"], "due", "taken", bucket="cover")) == {(0, 1), (0, 2), (0, 3), (0, 4)}


def test_left_rows_without_reading_stay_once(spark):
    e, r = frames(spark, [at(0), at(6000)], [at(-180)])
    assert matches(joins.interval_join(e, r, ["place"], "due", "taken")) == {(0, 0), (1, None)}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    events=st.lists(st.integers(0, 2000), min_size=1, max_size=25),
    readings=st.lists(st.integers(-300, 2000), min_size=1, max_size=40),
)
def test_interval_join_is_brute_force(spark, events, readings):
    e, r = frames(spark, [at(m) for m in events], [at(m) for m in readings])
    want = {(i, j) for i, a in enumerate(events) for j, b in enumerate(readings) if a - 240 <= b <= a - 120}
    assert matches(joins.interval_join(e, r, ["place"], "due", "taken", how="inner")) == want


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_latest_reading_needs_no_copies(spark, kind, how):
    events, readings = [at(97 * i) for i in range(25)], [at(-1500 + 61 * (i % 23)) for i in range(40)]
    e, r = frames(spark, [*events, None], [*readings, None])
    e, r = e.withColumn("due", F.col("due").cast(kind)), r.withColumn("taken", F.col("taken").cast(kind))
    out = joins.interval_join(e, r, ["place"], "due", "taken", -24, -2, how, pick="latest", event_id=["id"])
    want = {(25, None)} if how == "left" else set()
    for i, a in enumerate(events):
        near = [(b, j) for j, b in enumerate(readings) if a - dt.timedelta(hours=24) <= b <= a - dt.timedelta(hours=2)]
        want |= {(i, max(near)[1])} if near else {(i, None)} if how == "left" else set()
    assert matches(out) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_long_interval_copies_readings_six_times_at_most(spark, kind):
    events, readings = [at(97 * i) for i in range(25)], [at(-1500 + 61 * i) for i in range(40)]
    e, r = frames(spark, events, readings)
    e, r = e.withColumn("due", F.col("due").cast(kind)), r.withColumn("taken", F.col("taken").cast(kind))
    asked, join = [], joins.salted_join
    try:
        joins.salted_join = lambda left, right, *rest: (asked.append(right), join(left, right, *rest))[1]
        out = joins.interval_join(e, r, ["place"], "due", "taken", lo_hours=-24, how="inner")
    finally:
        joins.salted_join = join
    want = {(i, j) for i, a in enumerate(events) for j, b in enumerate(readings)
            if a - dt.timedelta(hours=24) <= b <= a - dt.timedelta(hours=2)}
    assert matches(out) == want and asked[0].groupBy("rid").count().agg(F.max("count")).first()[0] <= 6


@pytest.mark.parametrize("kinds", [("timestamp", "timestamp_ntz"), ("timestamp_ntz", "timestamp_ntz"), ("timestamp", "timestamp")])
@pytest.mark.parametrize("bucket", ["start", "cover"])
def test_interval_pairs_cost_two_comparisons(spark, kinds, bucket):
    events, readings = [at(97 * i) for i in range(25)], [at(-300 + 61 * (i % 33)) for i in range(40)]
    e, r = frames(spark, [*events, None], [*readings, None])
    e, r = e.withColumn("due", F.col("due").cast(kinds[0])), r.withColumn("taken", F.col("taken").cast(kinds[1]))
    out = joins.interval_join(e, r, ["place"], "due", "taken", bucket=bucket)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joined = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "hours" not in joined and "cast" not in joined, joined
    want = {(25, None)}
    for i, a in enumerate(events):
        lo = a - dt.timedelta(hours=4)
        end = min(a - dt.timedelta(hours=2), lo.replace(minute=59)) if bucket == "start" else a - dt.timedelta(hours=2)
        want |= {(i, j) for j, b in enumerate(readings) if lo <= b <= end} or {(i, None)}
    assert matches(out) == want and out.columns == [*e.columns, "rid", "taken"]


def test_interval_join_measures_buckets_of_hot_keys_only(spark):
    e, r = frames(spark, [at(7 * i) for i in range(20)], [at(-180)])
    asked, measure = [], keyed.largest_group
    try:
        keyed.largest_group = lambda df, keys: (asked.append(list(keys)), measure(df, keys))[1]
        for limit in (20, 19):
            keyed.salted_join(e.withColumn("h", F.hour("due")), r.withColumn("h", F.lit(1)), ["place", "h"], limit=limit, coarse=["place"])
    finally:
        keyed.largest_group = measure
    assert asked == [["place"], ["place"], ["place", "h"]]


def test_interval_join_with_hot_key(small_groups):
    spark = small_groups
    events, readings = [at(i % 55) for i in range(300)], [at(-240 + 7 * i) for i in range(30)]
    e, r = frames(spark, events, readings)
    want = {(i, j) for i, a in enumerate(events) for j, b in enumerate(readings)
            if a - dt.timedelta(hours=4) <= b <= a - dt.timedelta(hours=2)}
    assert matches(joins.interval_join(e, r, ["place"], "due", "taken", how="inner")) == want


def great_circle(a, b):
    (la, lo), (lb, lp) = ((math.radians(x) for x in p) for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * maths.RADIUS_KM * math.asin(math.sqrt(min(h, 1)))


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_is_brute_force(spark, k):
    # A dense town, far outliers, poles, the date line and two stations at one spot.
    left = [(i, -89.9 + (i * 37 % 1798) / 10, -180 + (i * 53 % 3600) / 10) for i in range(120)]
    right = [(i, 10 + i / 500, 20 + (i * 7 % 50) / 500) for i in range(400)]
    right += [(900, 89.9, 0.0), (901, -89.9, 170.0), (902, 0.0, 179.9), (903, 0.0, -179.9), (905, 40.0, -70.0), (904, 40.0, -70.0)]
    a = spark.createDataFrame(left, "place int, lat double, lon double")
    b = spark.createDataFrame(right, "station int, slat double, slon double")
    got = joins.nearest(a, b, ("place", "lat", "lon"), ("station", "slat", "slon"), k=k).collect()
    assert len(got) == k * len(left)
    by_place = {}
    for r in got:
        by_place.setdefault(r.place, {})[r["rank"]] = (r.station, r.distance_km)
    for i, lat, lon in left:
        want = sorted((great_circle((lat, lon), (sl, so)), s) for s, sl, so in right)[:k]
        for n, (d, _) in enumerate(want, 1):
            assert by_place[i][n][1] == pytest.approx(d, abs=1e-6)


def test_distance_is_linear_in_radius(spark):
    lat1, lon1, lat2, lon2 = (F.lit(float(x)) for x in (0, 0, 0, 90))
    row = spark.range(1).select(
        maths.haversine_km(lat1, lon1, lat2, lon2, 1.0).alias("a"), maths.haversine_km(lat1, lon1, lat2, lon2, 6371.0).alias("b")
    ).first()
    assert row.a == pytest.approx(math.pi / 2) and row.b == pytest.approx(6371 * math.pi / 2)


def test_asof_with_hot_key(small_groups, sf):
    from oracle_check import compare, duck

    from millrace.plans.catalog import ORACLES, QUERIES

    for name in ("asof_backward", "asof_forward", "global_percent_rank", "exact_quantiles", "trailing_rate", "macd", "plain_trailing_stops"):
        ok, note = compare(small_groups, duck(sf), name, QUERIES[name], ORACLES[name], sf)
        assert ok, f"{name}: {note}"


def test_asof_with_null_keys_and_times(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "a", None), (4, "a", 1), (5, "b", 9)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 2, 10), ("a", 7, 11), (None, 3, 12), ("a", None, 13), ("b", None, 14)], "k string, rt int, v int")
    want = {"backward": {1: 10, 2: None, 3: None, 4: None, 5: None}, "forward": {1: 11, 2: None, 3: None, 4: 10, 5: None}}
    for direction, found in want.items():
        got = joins.asof(left, right, ["k"], "t", "rt", ["v"], direction).collect()
        assert {r["id"]: r["matched_v"] for r in got} == found


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_of_far_points_meets_few(spark, k, monkeypatch):
    import random

    rng = random.Random(5)
    near = [(f"l{i}", rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(60)] + [(f"m{i}", rng.uniform(60, 80), rng.uniform(90, 100)) for i in range(60)]
    far = [(f"r{i}", rng.uniform(-30, -10), rng.uniform(150, 179)) for i in range(400)]
    a, b = spark.createDataFrame(near, "place string, lat double, lon double"), spark.createDataFrame(far, "station string, slat double, slon double")
    met = []
    whole = joins._descend
    monkeypatch.setattr(joins, "_descend", lambda *x: met.append(whole(*x)) or met[-1])
    got = joins.nearest(a, b, ("place", "lat", "lon"), ("station", "slat", "slon"), k=k).collect()
    assert met[0].count() < 0.4 * len(near) * len(far)

    def away(p, q):
        f1, f2, d = math.radians(p[1]), math.radians(q[1]), math.radians(q[2] - p[2])
        h = math.sin((f2 - f1) / 2) ** 2 + math.cos(f1) * math.cos(f2) * math.sin(d / 2) ** 2
        return math.asin(math.sqrt(h))

    want = {(p[0], n + 1): q[0] for p in near for n, q in enumerate(sorted(far, key=lambda q: (away(p, q), q[0]))[:k])}
    assert {(r["place"], r["rank"]): r["station"] for r in got} == want
