"""Replays of bars: window scans, trailing stops and divergence trading.

Positions depend on all bars before, so symbols are folded in time order.
Signals, turning points and extremes come from window operators beforehand;
the Python steps only keep the books.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import maths
from millrace.operators.joins import day_low
from millrace.operators.keyed import attach, join_on
from millrace.operators.ladder import ROWS, WIDTH, Blocks, Ladder, ahead, first
from millrace.operators.ordered import fold, with_halo
from millrace.operators.series import CLASSIC_SPANS, LOW_BUFFER, REVERSAL, RISE_OF_MINIMUM, pivot_scan

# Stop rules.
STOP = 0.94
STOP_FLOOR = 0.9
STOP_STEP = 0.01
RISE_STEP = 1.1
HALF_SELL = 1.05
# Divergence trading.
LEVERAGE = 2.0
TIME_STOP_DAYS = 30
STOP_LOSS = 0.05
STOP_PROFIT = 0.2
# Fixed values: (window, age) in bars for seven bars a day and for hourly bars round the clock.
SEVEN_A_DAY = (147, 21)
ROUND_THE_CLOCK = (504, 72)

_DAY_MICROS = 86_400_000_000


def _micros(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn("__time", F.unix_micros(F.col(time).cast("timestamp")))


# --- replay of every window -------------------------------------------------


def _ema(x: np.ndarray, span: int) -> np.ndarray:
    """Average along the last axis, all windows at once."""
    a, out = 2.0 / (span + 1.0), np.empty_like(x)
    out[:, 0] = x[:, 0]
    for i in range(1, x.shape[1]):
        out[:, i] = a * x[:, i] + (1 - a) * out[:, i - 1]
    return out


def _last_signals(closes: np.ndarray) -> np.ndarray:
    """Position of the last signal in each window, -1 without one."""
    short, long, _ = CLASSIC_SPANS
    diff = _ema(closes, short) - _ema(closes, long)
    sign = np.sign(np.diff(diff, axis=1))
    before = np.concatenate([sign[:, :1], sign[:, :-1]], axis=1)
    is_min = np.zeros(diff.shape, bool)
    is_min[:, :-1] = sign > before
    last = np.full(len(closes), -1)
    for r in np.flatnonzero(is_min.any(axis=1)):
        at = np.flatnonzero(is_min[r])
        low, price = diff[r, at], closes[r, at]
        prev = low[:-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            rise = np.where(prev != 0, np.diff(low) / np.abs(prev), -np.inf)
        hits = np.flatnonzero((rise >= RISE_OF_MINIMUM) & (np.diff(price) < 0))
        if len(hits):
            last[r] = at[hits[-1] + 1]
    return last


def _buy_position(closes: np.ndarray, signal: int) -> int:
    """Position of the buy point of one window, -1 without one."""
    pivots, _ = pivot_scan(range(len(closes)), closes.tolist(), True, REVERSAL)
    if len(pivots) < 4:
        return -1
    odd_low = pivots[1][1] < pivots[2][1]
    marked = None
    for n, (at, price) in enumerate(pivots):
        if n and at >= signal and (n % 2 == 1) != odd_low:
            marked = price
            break
    if marked is None:
        return -1
    for n, (at, price) in enumerate(pivots):
        if n and at >= signal and (n % 2 == 1) == odd_low and price > marked:
            return at
    return -1


def replay_windows(
    bars: DataFrame, symbol: str, time: str, window: int, age: int, block_rows: int = 4096
) -> DataFrame:
    """Buy points found by looking at every window of bars as if it were all there is.

    Indicators depend on where a window starts, so they are computed per window.
    Windows ending in one block of bars are handled by one task, which gets the
    ``window - 1`` bars before it; no window is ever materialised as rows. One
    row per window that yields a buy point younger than ``age`` bars; each
    symbol's very last window is not visited.
    """
    base = bars.select(symbol, time, F.col("close").cast("double").alias("close"))
    base = attach(day_low(base, base, symbol, time, "close"), [symbol], {"__n": F.count(F.lit(1))}, source=base)
    blocks = with_halo(base, [symbol], [time], window - 1, 0, block_rows)
    schema = T.StructType(
        [base.schema[symbol], T.StructField("seen_at", base.schema[time].dataType), T.StructField("buy_time", base.schema[time].dataType)]
    )

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__rn")
        closes, lows = pdf["close"].to_numpy(), pdf["day_low"].to_numpy()
        rn, own, n = pdf["__rn"].to_numpy(), pdf["__own"].to_numpy(), pdf["__n"].iloc[0]
        out = []
        if len(closes) >= window:
            views = np.lib.stride_tricks.sliding_window_view(closes, window)
            ends = np.arange(window - 1, len(closes))
            wanted = np.flatnonzero(own[ends] & (rn[ends] < n))
            signals = _last_signals(views[wanted])
            for r, s in zip(wanted, signals):
                if s < 0:
                    continue
                c, first = views[r], r
                if s + 1 < window:
                    low = LOW_BUFFER * c[s + 1 :].min()
                    if low < c[s] and low < lows[first + s]:
                        continue
                at = _buy_position(c, s)
                if at >= 0 and window - 1 - at < age:
                    out.append((first + window - 1, first + at))
        seen, buy = (np.array(x, dtype=int) for x in (zip(*out) if out else ((), ())))
        times = pdf[time].to_numpy()
        return pd.DataFrame({symbol: pdf[symbol].iloc[0], "seen_at": times[seen], "buy_time": times[buy]})

    return blocks.groupBy(symbol, "__block").applyInPandas(scan, schema)


def second_sightings(found: DataFrame, symbol: str) -> DataFrame:
    """Per buy point all sightings in order, and the second one where a trade opens.

    A buy point is seen by fewer windows than the age limit, which bounds the list.
    """
    out = found.groupBy(symbol, "buy_time").agg(F.sort_array(F.collect_list("seen_at")).alias("seen"))
    return out.withColumn("entry_time", F.try_element_at("seen", F.lit(2)))


# --- trailing stop ----------------------------------------------------------


# The stop's share of the high, one after each tightening.
COEFFICIENTS = [STOP]
while COEFFICIENTS[-1] > STOP_FLOOR:
    COEFFICIENTS.append(max(STOP_FLOOR, COEFFICIENTS[-1] - STOP_STEP))
_SHARES = np.array(COEFFICIENTS)


def open_trades(entry: np.ndarray, child: np.ndarray) -> dict[str, np.ndarray]:
    """Trades just opened, as a dict of arrays; each goes on at ``child`` of its block."""
    n = len(entry)
    return {"entry": entry, "__child": child, "high": entry.copy(), "tightened": np.zeros(n, np.int64), "step": entry * RISE_STEP, "booked": np.full(n, np.nan), "price": np.full(n, np.nan)}


def _changes(blocks: Blocks, trades: dict, half: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First child of each trade's block with a sale, a booking or a tightening (-1: none), the
    high before it, and the high after the whole block."""
    part = ahead(blocks, trades["__child"])
    highs = np.maximum.accumulate(np.column_stack([trades["high"], part.high]), axis=1)
    before = highs[:, :-1]
    hits = (part.low < _SHARES[trades["tightened"]][:, None] * before) | (part.falls >> trades["tightened"][:, None] & 1).astype(bool)
    if half:
        tighter = (trades["tightened"] + 1 < len(_SHARES))[:, None]
        hits |= tighter & (part.high > np.maximum(before, trades["step"][:, None]))
        hits |= np.isnan(trades["booked"])[:, None] & (part.high > (trades["entry"] * HALF_SELL)[:, None])
    at = first(hits)
    return at, before[np.arange(len(at)), at], highs[:, -1]


def sell(blocks: Blocks, trades: dict, half: bool) -> np.ndarray:
    """Where in its block of closes each trade is sold, -1 if it stays open; updates the trades."""
    sold = np.full(len(trades["entry"]), -1)
    on = np.arange(len(sold))
    while len(on):
        mine = Blocks(blocks.high[on], blocks.low[on], blocks.falls[on])
        at, before, after = _changes(mine, {k: v[on] for k, v in trades.items()}, half)
        trades["high"][on[at < 0]] = after[at < 0]
        on, at, before = on[at >= 0], at[at >= 0], before[at >= 0]
        close, entry, tightened = blocks.high[on, at], trades["entry"][on], trades["tightened"][on]
        out = close < _SHARES[tightened] * before
        if half:
            books = np.isnan(trades["booked"][on]) & (close > entry * HALF_SELL)
            trades["booked"][on[books]] = ((close - entry) / entry)[books]
            rises = ~out & (close > np.maximum(before, trades["step"][on])) & (tightened + 1 < len(_SHARES))
            trades["step"][on[rises]] *= RISE_STEP
            trades["tightened"][on[rises]] += 1
        sold[on[out]], trades["price"][on[out]] = at[out], close[out]
        trades["high"][on] = np.maximum(before, close)
        trades["__child"][on] = at + 1
        on = on[~out]
    return sold


def sell_along(trades: dict, closes: np.ndarray, half: bool) -> np.ndarray:
    """``sell`` for any number of trades over one stretch of closes."""
    sold = np.full(len(trades["entry"]), -1)
    for at in range(0, len(sold), ROWS):
        some = {k: v[at : at + ROWS] for k, v in trades.items()}  # views: updates reach ``trades``
        shape = (len(some["entry"]), len(closes))
        prices = np.broadcast_to(closes, shape)
        sold[at : at + ROWS] = sell(Blocks(prices, prices, np.zeros(shape, np.int64)), some, half)
    return sold


def _look_for_stop(half: bool):
    def look(blocks: Blocks, trades: dict, values: bool) -> tuple[np.ndarray, np.ndarray]:
        if values:
            at = sell(blocks, trades, half)
            return at, at >= 0
        at, before, after = _changes(blocks, trades, half)
        trades["high"] = np.where(at >= 0, before, after)
        return at, np.zeros(len(at), bool)

    return look


def trade_return(entry, price, booked):
    """Gain over the entry; half of it as booked, where half was booked. Columns or arrays."""
    now = (price - entry) / entry
    return now, 0.5 * booked + 0.5 * now


def trailing_stops(
    bars: DataFrame, entries: DataFrame, symbol: str, time: str, half_sell: bool = True, width: int = WIDTH
) -> DataFrame:
    """Exit and return of every trade opened at the close of an entry bar.

    ``entries`` holds symbol and time. Trades still open on the symbol's last bar
    are sold there; one opened on it has no return. With ``half_sell`` half is
    booked above a 5 % gain and the stop tightens with each further 10 % rise. Bars without a
    close are no bars, and entries there or without a symbol no entries.

    A stop is a fall below a share of the highest close since the entry. Block summaries tell
    where such a fall, a booking or a tightening can be, so a trade descends to a few blocks of closes,
    at most once for each of them, and open trades are never gathered.
    """
    ladder = Ladder(_micros(bars, time), symbol, "__time", "close", COEFFICIENTS, width)
    marks = _micros(entries, time).select(symbol, F.col("__time").alias("__order")).distinct()
    last = ladder.numbered.groupBy(symbol).agg(F.max_by(F.struct("__at", "__order", "__value"), "__at").alias("__end"))
    opened = join_on(ladder.numbered, marks, [symbol, "__order"], "inner", null_safe=False)
    opened = join_on(opened, last, [symbol], "inner", null_safe=False).where(F.col("__at") < F.col("__end.__at"))
    entry = F.col("__value")
    trades = opened.select(
        symbol, (F.col("__at") + 1).alias("__from"), entry.alias("entry"), F.col("__order").alias("__in"), F.col("__end.__order").alias("__end_time"),
        F.col("__end.__value").alias("__end_price"), entry.alias("high"), F.lit(0).cast("long").alias("tightened"), (entry * RISE_STEP).alias("step"),
        F.lit(None).cast("double").alias("booked"), F.lit(None).cast("double").alias("price"),
    )
    out = ladder.search(trades, _look_for_stop(half_sell))
    stopped = F.col("__found").isNotNull()
    price = F.when(stopped, F.col("price")).otherwise(F.col("__end_price"))
    now, halved = trade_return(F.col("entry"), price, F.col("booked"))
    return out.select(
        symbol, F.timestamp_micros("__in").alias("entry_time"), F.col("entry").alias("entry_price"),
        F.timestamp_micros(F.when(stopped, F.col("__carry")).otherwise(F.col("__end_time"))).alias("exit_time"),
        price.alias("exit_price"), F.coalesce(halved, now).alias("ret"), stopped.cast("int").alias("stopped"),
    )


# --- divergence trading -----------------------------------------------------


def _exit_due(side: int, entry: float, held_days: int, against: int, p: float) -> bool:
    """Opposite divergence, then time stop, then loss or profit."""
    gain = side * (p - entry)
    return bool(against) or held_days > TIME_STOP_DAYS or gain <= -STOP_LOSS * entry or gain >= STOP_PROFIT * entry


def _book_step(capital: float):
    def step(key: tuple, state: dict | None, rows: pd.DataFrame) -> tuple[pd.DataFrame, dict]:
        s = state or {str(side): {"book": capital / 2, "entry": None, "at": None, "units": 0.0} for side in (1, -1)}
        s = {k: dict(v) for k, v in s.items()}
        equity = sum(b["book"] for b in s.values())
        out = []
        cols = ("__time", "close", "is_bottom", "is_top", "bullish", "bearish")
        for t, p, bottom, top, bull, bear in zip(*(rows[c].tolist() for c in cols)):
            before, done = equity, {}
            for side, turn, push, against in ((1, bottom, bull, bear), (-1, top, bear, bull)):
                b = s[str(side)]
                if b["entry"] is None:
                    if turn == 1 and push == 1:
                        b.update(entry=p, at=t, units=b["book"] * LEVERAGE / p)
                        done[side] = side
                elif _exit_due(side, b["entry"], (t - b["at"]) // _DAY_MICROS, against, p):
                    b["book"] += side * (p - b["entry"]) * b["units"]
                    b.update(entry=None, at=None, units=0.0)
                    done[side] = 0
            equity = sum(b["book"] for b in s.values())
            out.append((t, p, done.get(1), done.get(-1), before, equity))
        frame = pd.DataFrame(out, columns=["__time", "close", "long_action", "short_action", "equity_before", "equity"])
        frame[["long_action", "short_action"]] = frame[["long_action", "short_action"]].astype("Int32")
        frame["__key"] = key[0]
        return frame, s

    return step


def divergence_trades(df: DataFrame, symbol: str, time: str, capital: float = 10_000.0) -> DataFrame:
    """Long and mirrored short book per symbol, one row per bar.

    Needs ``series.turning_points`` and ``series.divergence_flags``. Actions are
    1 and -1 for opening, 0 for closing. ``equity_before`` is the equity the bar
    starts with, the initial capital on the first one.
    """
    rows = _micros(df, time).select(
        symbol, "__time", F.col("close").cast("double").alias("close"), "is_bottom", "is_top", "bullish", "bearish"
    )
    schema = T.StructType(
        [
            T.StructField("__key", rows.schema[symbol].dataType),
            T.StructField("__time", T.LongType()),
            T.StructField("close", T.DoubleType()),
            T.StructField("long_action", T.IntegerType()),
            T.StructField("short_action", T.IntegerType()),
            T.StructField("equity_before", T.DoubleType()),
            T.StructField("equity", T.DoubleType()),
        ]
    )
    out = fold(rows, [symbol], ["__time"], _book_step(capital), schema)
    return out.select(
        F.col("__key").alias(symbol), F.timestamp_micros("__time").alias(time), "close", "long_action", "short_action",
        "equity_before", "equity",
    )


def position_log(books: DataFrame, symbol: str, time: str) -> DataFrame:
    """One row per action: book, time, action and price."""
    acts = F.array(
        F.struct(F.lit("long").alias("book"), F.col("long_action").alias("action")),
        F.struct(F.lit("short").alias("book"), F.col("short_action").alias("action")),
    )
    return books.select(symbol, time, F.col("close").alias("price"), F.inline(acts)).filter("action is not null")


def performance(books: DataFrame, symbol: str, time: str) -> DataFrame:
    """Sharpe ratio of bar-to-bar equity changes (0 without variation), fall from the peak, final equity."""
    ret = F.col("equity") / F.col("equity_before") - 1
    out = books.groupBy(symbol).agg(
        F.avg(ret).alias("__m"),
        F.stddev(ret).alias("__s"),
        F.greatest(F.max("equity"), F.max("equity_before")).alias("__peak"),
        F.min_by("equity_before", time).alias("initial"),
        F.max_by("equity", time).alias("final"),
    )
    return out.select(
        symbol,
        F.coalesce(maths.share(F.col("__m"), F.col("__s")), F.lit(0.0)).alias("sharpe"),
        F.coalesce(maths.share(F.col("__peak") - F.col("final"), F.col("__peak")), F.lit(0.0)).alias("drawdown"),
        "initial",
        "final",
    )
