import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import series, trading
from millrace.plans.tables import bars
from millrace.streaming import bars as live

T0 = dt.datetime(2024, 1, 1)


def frame(spark, closes, symbol="s"):
    rows = [(symbol, T0 + dt.timedelta(hours=i), float(c), float(c) + 1, float(c) - 1) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, close double, high double, low double")


def walk(n, seed, sigma=0.01):
    return 100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, sigma, n)))


def test_half_sell_stop(spark):
    df = frame(spark, [100, 104, 106, 99])
    entry = df.filter(F.col("ts") == T0)
    row = trading.trailing_stops(df, entry, "symbol", "ts").first()
    assert row.ret == pytest.approx(0.025) and row.exit_price == 99 and row.stopped == 1


def test_open_trades_are_sold_on_the_last_bar(spark):
    df = frame(spark, [100, 101, 102])
    got = {r.entry_price: r.ret for r in trading.trailing_stops(df, df, "symbol", "ts", half_sell=False).collect()}
    assert got == {100.0: pytest.approx(0.02), 101.0: pytest.approx(1 / 101)}


def test_stop_tightens_with_rises(spark):
    # 111 > 110 tightens to 0.93, 122 > 121 to 0.92: the stop is 112.24
    df = frame(spark, [100, 111, 122, 113, 112])
    row = trading.trailing_stops(df, df.filter(F.col("ts") == T0), "symbol", "ts").first()
    assert row.exit_price == 112 and row.ret == pytest.approx(0.5 * 0.11 + 0.5 * 0.12)


def test_pivots(spark):
    df = frame(spark, [100, 102, 101.9, 105, 103, 103.5, 101, 102.5, 102.4])
    got = [(r.close, r.pivot_no) for r in series.zigzag(df, "symbol", "ts", 0.01).orderBy("ts").collect()]
    assert got == [(100.0, 0), (105.0, 1), (101.0, 2), (102.5, 3), (102.4, 4)]


def test_pivots_in_pieces_equal_pivots_at_once(spark, small_groups):
    from millrace.session import GROUP_ROWS_KEY

    df = frame(spark, walk(300, 1))
    pieces = [tuple(r) for r in series.zigzag(df, "symbol", "ts").orderBy("ts").collect()]
    small_groups.conf.set(GROUP_ROWS_KEY, "100000")
    assert pieces == [tuple(r) for r in series.zigzag(df, "symbol", "ts").orderBy("ts").collect()]


def test_split_needs_four_pivots(spark):
    pivots = spark.createDataFrame([("a", 1, 10.0, 0), ("a", 2, 20.0, 1), ("a", 3, 9.0, 2)], "symbol string, ts int, close double, pivot_no int")
    assert series.split_pivots(pivots, "symbol", "ts").count() == 0
    more = pivots.unionByName(spark.createDataFrame([("a", 4, 15.0, 3)], pivots.schema))
    got = {r.ts: r.kind for r in series.split_pivots(more, "symbol", "ts").collect()}
    assert got == {2: "high", 3: "low", 4: "high"}


def one_window(closes, lows, age):
    """The rule for a single window, written out plainly."""
    s = pd.Series(closes)
    ema = lambda x, n: x.ewm(span=n, adjust=False).mean()
    diff = (ema(s, 12) - ema(s, 26)).tolist()
    sign = lambda v: (v > 0) - (v < 0)
    steps = [sign(diff[i + 1] - diff[i]) for i in range(len(diff) - 1)]
    steps = [steps[0], *steps]
    minima = [i for i in range(len(diff) - 1) if steps[i + 1] > steps[i]]
    signal = None
    for a, b in zip(minima, minima[1:]):
        if diff[a] != 0 and (diff[b] - diff[a]) / abs(diff[a]) >= 0.2 and closes[b] < closes[a]:
            signal = b
    if signal is None:
        return None
    later = closes[signal + 1 :]
    if later and 1.005 * min(later) < closes[signal] and 1.005 * min(later) < lows[signal]:
        return None
    pivots, _ = series.pivot_scan(range(len(closes)), closes, True, series.REVERSAL)
    if len(pivots) < 4:
        return None
    odd = "low" if pivots[1][1] < pivots[2][1] else "high"
    kinds = [(p, c, odd if n % 2 else {"low": "high", "high": "low"}[odd]) for n, (p, c) in enumerate(pivots) if n]
    highs = [c for p, c, k in kinds if k == "high" and p >= signal]
    if not highs:
        return None
    buys = [p for p, c, k in kinds if k == "low" and p >= signal and c > highs[0]]
    return buys[0] if buys and len(closes) - 1 - buys[0] < age else None


def test_replay_equals_each_window_alone(spark):
    window, age, closes = 60, 40, [round(float(c), 2) for c in walk(700, 4, 0.012)]
    df = frame(spark, closes)
    days = pd.Series(closes).groupby(np.arange(len(closes)) // 24).transform("min").tolist()
    want = set()
    for i in range(len(closes) - window):
        at = one_window(closes[i : i + window], days[i : i + window], age)
        if at is not None:
            want.add((T0 + dt.timedelta(hours=i + window - 1), T0 + dt.timedelta(hours=i + at)))
    for rows in (4096, 97):
        got = {(r.seen_at, r.buy_time) for r in trading.replay_windows(df, "symbol", "ts", window, age, rows).collect()}
        assert got == want
    assert want


def test_second_sighting(spark):
    rows = [("s", 5, 1), ("s", 3, 1), ("s", 4, 1), ("s", 9, 2)]
    found = spark.createDataFrame(rows, "symbol string, seen_at int, buy_time int")
    got = {r.buy_time: (r.seen, r.entry_time) for r in trading.second_sightings(found, "symbol").collect()}
    assert got == {1: ([3, 4, 5], 4), 2: ([9], None)}


def test_divergence_books(spark):
    flat = {"is_bottom": 0, "is_top": 0, "bullish": 0, "bearish": 0}
    rows = [
        (0, 100.0, flat),
        (1, 100.0, {**flat, "is_bottom": 1, "bullish": 1}),  # long: 5000 * 2 / 100 = 100 units
        (2, 110.0, {**flat, "bullish": 1}),
        (3, 120.0, {**flat, "bullish": 1}),  # profit of 20 %
        (4, 120.0, {**flat, "is_top": 1, "bearish": 1}),  # short: 5000 * 2 / 120 units
        (5, 127.0, {**flat, "bearish": 1}),  # loss over 5 %
    ]
    df = spark.createDataFrame(
        [("s", T0 + dt.timedelta(hours=i), c, *(f[k] for k in flat)) for i, c, f in rows],
        "symbol string, ts timestamp, close double, is_bottom int, is_top int, bullish int, bearish int",
    )
    books = trading.divergence_trades(df, "symbol", "ts").orderBy("ts").collect()
    assert [(b.long_action, b.short_action) for b in books] == [(None, None), (1, None), (None, None), (0, None), (None, -1), (None, 0)]
    assert books[3].equity == pytest.approx(12_000) and books[3].equity_before == 10_000
    assert books[5].equity == pytest.approx(12_000 - 7 * 10_000 / 120)
    perf = trading.performance(trading.divergence_trades(df, "symbol", "ts"), "symbol", "ts").first()
    assert perf.initial == 10_000 and perf.final == pytest.approx(books[5].equity)
    assert perf.drawdown == pytest.approx(1 - books[5].equity / 12_000)
    changes = pd.Series([10_000, *(b.equity for b in books)]).pct_change().dropna()
    assert perf.sharpe == pytest.approx(changes.mean() / changes.std())
    log = {(r.ts, r.book, r.action) for r in trading.position_log(trading.divergence_trades(df, "symbol", "ts"), "symbol", "ts").collect()}
    assert len(log) == 4


def test_books_in_pieces_equal_books_at_once(spark, small_groups, sf):
    from millrace.plans.trading import _books
    from millrace.session import GROUP_ROWS_KEY

    def rows():
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in _books(spark, sf).select("symbol", "ts", "equity").collect())

    pieces = rows()
    small_groups.conf.set(GROUP_ROWS_KEY, "100000")
    assert pieces == rows()


def test_later_history_does_not_change_but_start_does(spark, sf):
    b = bars(spark, sf).filter("symbol = 3")
    full = series.macd(b, "symbol", "ts", weighted=False)
    early = series.macd(b.filter(F.col("ts") < "2024-01-16"), "symbol", "ts", weighted=False)
    same = {r["column"]: (r.n, r.n_same) for r in series.stable_values(full, early, ["symbol", "ts"], ["diff", "dea"]).collect()}
    assert all(n == s for n, s in same.values())


@pytest.mark.parametrize("days, per_trigger", [(range(10), 1), ([7, 2, 9, 0, 4, 1, 8, 3, 6, 5], 1), (range(9, -1, -1), 3), ([5, 0, 9], 100)])
def test_streamed_stops_do_not_depend_on_files(spark, tmp_path, days, per_trigger):
    closes = walk(240, 9, 0.02)
    df = frame(spark, closes).withColumn("is_entry", F.when(F.hour("ts") == 3, 1).otherwise(0)).select("symbol", "ts", "close", "is_entry")
    days = list(days)
    df = df.where(F.datediff("ts", F.lit(T0.date())).isin(days))
    batch = trading.trailing_stops(df, df.filter("is_entry = 1"), "symbol", "ts").filter("stopped = 1")
    folder = str(tmp_path / "bars")
    for day in days:
        df.filter(F.datediff("ts", F.lit(T0.date())) == day).coalesce(1).write.mode("append").parquet(folder)
    live.clock_row(df, "ts", "20 days").coalesce(1).write.mode("append").parquet(folder)
    stream = live.stream_table(spark, folder, df.schema, "*.parquet", per_trigger=per_trigger)
    got = live.drain(live.live_stops(stream, "symbol", "ts", "20 days"))
    rows = lambda d: sorted((r.entry_time, r.exit_time, round(r.ret, 9)) for r in d.collect())
    assert rows(got) == rows(batch) and rows(got)


@pytest.mark.parametrize("per_trigger", [1, 100])
def test_streamed_dedupe_and_join_do_not_depend_on_files(spark, tmp_path, per_trigger):
    rows = [(k, k % 3, T0 + dt.timedelta(hours=k * 7 % 240)) for k in range(120)]
    df = spark.createDataFrame(rows, "id int, place int, ts timestamp")
    folder = str(tmp_path / "rows")
    for part in (3, 0, 4, 1, 2, 0, 3):  # parts 0 and 3 come twice
        df.filter(F.col("id") % 5 == part).coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: live.stream_table(spark, folder, df.schema, "*.parquet", per_trigger=per_trigger)
    once = live.drain(live.without_repeats(stream(), ["id"], "ts", "20 days"))
    assert sorted(r.id for r in once.collect()) == list(range(120))
    events = stream().select(F.col("id").alias("event"), "place", F.col("ts").alias("due"))
    readings = stream().select(F.col("id").alias("reading"), "place", F.col("ts").alias("taken"))
    got = live.drain(live.timed_join(events, readings, "place", "due", "taken", "20 days").select("event", "reading"))
    times = {k: t for k, _, t in rows}
    want = {(a, b) for a in times for b in times if a % 3 == b % 3 and dt.timedelta(hours=-4) <= times[b] - times[a] <= dt.timedelta(hours=-2)}
    assert {(r.event, r.reading) for r in got.collect()} == want and want
