"""Searches by block summaries against plain scans."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import ladder, series, trading

T0 = dt.datetime(2024, 1, 1)
MICROS = 3_600_000_000


def walk(n, seed, sigma=0.012):
    return np.round(100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, sigma, n))), 2).tolist()


def bars_of(spark, symbols):
    rows = [(s, T0 + dt.timedelta(hours=i), None if p is None else float(p)) for s, closes in symbols.items() for i, p in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, close double")


def plain_exit(closes, at, half):
    """The rule bar by bar, from its statement: highs, the share of them that is the stop, one booking."""
    entry = closes[at]
    rises, booked = 0, None
    seen = [entry]
    goal = entry * 1.1
    shares = [0.94]
    while shares[-1] > 0.9:
        shares.append(max(0.9, shares[-1] - 0.01))
    for j in range(at + 1, len(closes)):
        p = closes[j]
        if half and booked is None and p > entry * 1.05:
            booked = (p - entry) / entry
        if p < shares[min(rises, len(shares) - 1)] * max(seen):
            break
        if half and p > max(seen) and p > goal:
            goal, rises = goal * 1.1, rises + 1
        seen.append(p)
    else:
        j = len(closes) - 1
        p = closes[j]
    now = (p - entry) / entry
    stopped = int(j < len(closes) - 1 or p < shares[min(rises, len(shares) - 1)] * max(seen))
    return j, now if booked is None else 0.5 * booked + 0.5 * now, stopped


@pytest.mark.parametrize("half", [True, False])
@pytest.mark.parametrize("width", [4, 7, 1024])
def test_stops_against_the_plain_rule(spark, half, width):
    symbols = {"hot": walk(420, 3), "rising": [100 * 1.011**i for i in range(120)], "jump": [100, 131, 131.5, 150, 140, 134.9, 200, 170], "one": [5.0], "flat": [7.0] * 30}
    df = bars_of(spark, symbols)
    got = {}
    for r in trading.trailing_stops(df, df, "symbol", "ts", half, width).collect():
        got[r.symbol, int((r.entry_time - T0).total_seconds() // 3600)] = (int((r.exit_time - T0).total_seconds() // 3600), r.ret, r.stopped)
    want = {(s, i): plain_exit(closes, i, half) for s, closes in symbols.items() for i in range(len(closes) - 1)}
    assert set(got) == set(want)
    for k, (at, ret, stopped) in want.items():
        assert got[k][0] == at and got[k][2] == stopped and got[k][1] == pytest.approx(ret, abs=1e-12), k


def test_stops_pass_over_missing_closes(spark):
    df = bars_of(spark, {"s": [100, None, 120, float("nan"), 90, None], None: [1, 2, 3]})
    got = trading.trailing_stops(df, df, "symbol", "ts", False).collect()
    assert {(r.entry_price, r.exit_price, r.stopped) for r in got} == {(100.0, 90.0, 1), (120.0, 90.0, 1)}
    none = df.limit(0)
    assert trading.trailing_stops(none, none, "symbol", "ts").count() == 0


@pytest.mark.parametrize("width", [3, 1024])
def test_first_value_above(spark, width):
    rng = np.random.default_rng(8)
    values = [("a", int(t), float(v)) for t, v in enumerate(rng.integers(0, 50, 200))] + [("b", 5, 1.0), ("b", 9, 3.0), (None, 1, 9.0)]
    asked = [("a", int(a), float(b)) for a, b in zip(rng.integers(-5, 220, 80), rng.integers(10, 55, 80), strict=True)]
    asked += [("b", 5, 1.0), ("b", 5, 0.5), ("b", 10, 0.0), (None, 0, 0.0), ("c", 0, 0.0), ("a", None, 0.0), ("a", 0, None), ("b", 0, float("nan"))]
    v = spark.createDataFrame(values, "k string, t long, v double")
    q = spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "i int, k string, after long, bound double")
    got = {r.i: (r.found_order, r.found_value) for r in ladder.first_above(v, "k", "t", "v", q, width).collect()}
    want = {}
    for i, (k, after, bound) in enumerate(asked):
        hits = [(t, x) for s, t, x in values if None not in (k, after, bound) and s == k and t >= after and x > bound]
        if hits:
            want[i] = min(hits)
    assert got == want


def test_buy_points_against_pairs(spark):
    rng = np.random.default_rng(11)
    at = lambda h: T0 + dt.timedelta(hours=int(h))
    pivots = [(s, at(3 * i), float(rng.integers(50, 150)), i, "high" if i % 2 else "low") for s in "ab" for i in range(60)]
    signals = [(s, at(h)) for s in "abc" for h in rng.choice(200, 40, replace=False)]
    p = spark.createDataFrame(pivots, "symbol string, ts timestamp, close double, pivot_no int, kind string")
    got = {(r.symbol, r.signal_time): (r.high_close, r.buy_time, r.buy_close) for r in series.buy_points(spark.createDataFrame(signals, "symbol string, ts timestamp"), p, "symbol", "ts").collect()}
    want = {}
    for s, t in signals:
        highs = [x for x in pivots if x[0] == s and x[4] == "high" and x[1] >= t]
        lows = [x for x in pivots if highs and x[0] == s and x[4] == "low" and x[1] >= t and x[2] > highs[0][2]]
        if lows:
            want[s, t] = (highs[0][2], lows[0][1], lows[0][2])
    assert got == want and want


def test_summaries_combine_in_any_grouping(spark):
    df = bars_of(spark, {"s": walk(300, 5)}).withColumn("o", F.unix_micros("ts"))
    for width in (5, 17):
        tree = ladder.Ladder(df, "symbol", "o", "close", trading.COEFFICIENTS, width)
        top = tree.levels[-1].collect()
        assert len(top) == 1 and len(tree.levels) == {5: 4, 17: 3}[width]
        closes = np.array([walk(300, 5)])
        whole = ladder.Blocks(closes, closes, np.zeros(closes.shape, np.int64)).summary(trading.COEFFICIENTS)
        again = ladder.Blocks(*[np.array([top[0][c]]) for c in ladder.SUMMARY]).summary(trading.COEFFICIENTS)
        assert [x.tolist() for x in whole] == [x.tolist() for x in again]


LIMITS = [0.0, 0.001, 0.004, 0.009, 0.02, 0.05, 0.3]


def plain_pivots(closes, limit):
    found, _ = series.pivot_scan(range(len(closes)), closes, True, limit)
    return found


def test_ripples_never_change_pivots():
    for seed in range(300):
        rng = np.random.default_rng(seed)
        closes = np.round(100 * np.exp(np.cumsum(rng.normal(0, rng.choice([0.002, 0.01, 0.1]), 80))), int(rng.choice([0, 1, 4])))
        at = series._turns(closes)
        points = list(zip(at.tolist(), closes[at].tolist(), strict=True))
        for limit in LIMITS:
            points = series.without_ripples(points, limit)
            times, prices = zip(*points, strict=True)
            assert series.pivot_scan(times, prices, True, limit)[0] == plain_pivots(closes.tolist(), limit)


def test_a_settled_block_forgets_what_came_before():
    rng = np.random.default_rng(1)
    for seed in range(400):
        closes = np.round(100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, 0.02, 40))), int(rng.choice([0, 1, 4]))).tolist()
        limit = float(rng.choice(LIMITS))
        points = list(enumerate(closes))
        at = series._settled(points, limit)
        if at is None:
            continue
        start = {"dir": -1, "hi": closes[at], "lo": closes[at], "hi_at": at, "lo_at": at, "out_at": None}
        _, want = series.pivot_scan(range(at + 1, 40), closes[at + 1 :], False, limit, start)
        for before in (rng.uniform(60, 160, 12).tolist() for _ in range(5)):
            _, state = series.pivot_scan(range(-12, 0), before, False, limit)
            _, got = series.pivot_scan(range(40), closes, False, limit, state)
            part = ("hi", "hi_at") if want["dir"] == 1 else ("lo", "lo_at")
            assert got["dir"] == want["dir"] and [got[c] for c in part] == [want[c] for c in part]


@pytest.mark.parametrize("block_rows", [11, 64, 5000])
def test_sweep_in_blocks_against_plain_scans(spark, block_rows):
    symbols = {"hot": walk(400, 21, 0.01), "calm": [100 + i * 0.01 for i in range(90)], "steps": [100 + (i // 30) * 5 for i in range(100)], "one": [4.0], "two": [4.0, 4.0], "fall": [100 - i for i in range(50)]}
    got = {}
    for r in series.threshold_sweep(bars_of(spark, symbols | {"gone": [None]}), "symbol", "ts", LIMITS, block_rows).orderBy("symbol", "threshold", "pivot_no").collect():
        got.setdefault((r.symbol, r.threshold), []).append((int((r.ts - T0).total_seconds() // 3600), r.close))
    assert got == {(s, h): plain_pivots(closes, h) for s, closes in symbols.items() for h in LIMITS}
