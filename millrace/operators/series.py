"""Indicators, turning points, signals and pivots over bars by symbol."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import maths
from millrace.operators.joins import asof, day_low
from millrace.operators.keyed import attach, join_on
from millrace.operators.ladder import first_above
from millrace.operators.ordered import bounded, ewm, fits, following, number_rows, running
from millrace.operators.windows import crossed, held_since_cross, local_minima, merge_runs
from millrace.session import max_group_rows, stage

# Indicator spans (short, long, signal) and signal thresholds.
WEIGHTED_SPANS = (5, 34, 5)
CLASSIC_SPANS = (12, 26, 9)
RISE_OF_MINIMUM = 0.2
LOW_BUFFER = 1.005
REVERSAL = 0.009
BACK_FILL = 5


def adjusted_close(df: DataFrame, name: str = "adjusted") -> DataFrame:
    return df.withColumn(name, F.col("close") + F.col("dividends"))


def weighted_price() -> Column:
    """Mean of the close and the bar's middle."""
    return ((F.col("high") + F.col("low")) / 2 + F.col("close")) / 2


def macd(
    df: DataFrame, symbol: str, time: str, weighted: bool = True, spans: tuple[int, int, int] | None = None
) -> DataFrame:
    """Columns ``diff``, ``dea`` and ``macd``.

    ``diff`` is the short minus the long average of the price, ``dea`` the
    average of ``diff``, ``macd`` twice their gap. The price is the weighted one
    with spans 5, 34, 5, or the close with spans 12, 26, 9.
    """
    short, long, signal = spans or (WEIGHTED_SPANS if weighted else CLASSIC_SPANS)
    price = weighted_price() if weighted else F.col("close").cast("double")
    base = df.withColumn("__price", price)
    if fits(df, [symbol], max_group_rows(df.sparkSession)):
        new = [T.StructField(n, T.DoubleType()) for n in ("diff", "dea", "macd")]
        schema = T.StructType(df.schema.fields + new)

        def averages(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(time, kind="stable")
            smooth = lambda x, span: x.ewm(span=span, adjust=False).mean()
            rows["diff"] = smooth(rows["__price"], short) - smooth(rows["__price"], long)
            rows["dea"] = smooth(rows["diff"], signal)
            rows["macd"] = 2 * (rows["diff"] - rows["dea"])
            return rows.drop(columns="__price")

        return base.groupBy(symbol).applyInPandas(averages, schema)
    out = ewm(base, [symbol], [time], {"__short": ("__price", short), "__long": ("__price", long)}, sizes=df)
    out = stage(out.withColumn("diff", F.col("__short") - F.col("__long")))
    out = ewm(out, [symbol], [time], {"dea": ("diff", signal)}, sizes=df)
    return out.withColumn("macd", 2 * (F.col("diff") - F.col("dea"))).drop("__price", "__short", "__long")


def crosses(df: DataFrame, symbol: str, time: str) -> DataFrame:
    """Plain and confirmed golden and dead crosses of ``diff`` and ``dea``, from one window."""
    return bounded(
        df, [symbol], [time],
        {
            "golden": crossed("diff", "dea"),
            "dead": crossed("dea", "diff"),
            "golden_confirmed": held_since_cross("diff", "dea"),
            "dead_confirmed": held_since_cross("dea", "diff"),
        },
        4,
    )


def turning_points(df: DataFrame, symbol: str, time: str) -> DataFrame:
    """Top and bottom flags on the first bar of each back-filled confirmed cross.

    A flag sits up to five bars before the cross that caused it;
    ``top_known_at`` and ``bottom_known_at`` say when it could be known.
    """

    def first_of_run(flag: str):
        # Back-filled here, not back-filled on the bar before; the first bar has none before it.
        def over(w: WindowSpec) -> Column:
            now = F.max(flag).over(w.rowsBetween(0, BACK_FILL))
            before = F.when(F.lag(flag).over(w).isNotNull(), F.max(flag).over(w.rowsBetween(-1, BACK_FILL - 1)))
            return F.when((now == 1) & (before == 0), 1).otherwise(0)

        return over

    def known(flag: str):
        seen = F.when(F.col(flag) == 1, F.col(time))
        return lambda w: F.min(seen).over(w.rowsBetween(0, BACK_FILL))

    return bounded(
        df, [symbol], [time],
        {
            "is_top": first_of_run("dead_confirmed"),
            "is_bottom": first_of_run("golden_confirmed"),
            "top_known_at": known("dead_confirmed"),
            "bottom_known_at": known("golden_confirmed"),
        },
        1, BACK_FILL,
    )


def divergence_flags(df: DataFrame, symbol: str, time: str, known: bool = False) -> DataFrame:
    """State of the last two bottoms and tops at every bar.

    ``bullish`` is 1 while the last bottom is lower than the one before and its
    ``macd`` higher; ``bearish`` while the last top is higher and its ``macd``
    lower. Only turning points at or before the bar count; with ``known`` only
    those already confirmed by then.
    """
    df = stage(df)
    previous = lambda c: lambda w: F.lag(c).over(w)
    bars = df.select(symbol, time, F.lit(1).alias("__bar"))
    marks = None
    for side, price, name, sign in (("bottom", "low", "bullish", -1), ("top", "high", "bearish", 1)):
        points = df.filter(F.col(f"is_{side}") == 1)
        points = bounded(points, [symbol], [time], {"__pp": previous(price), "__pm": previous("macd")}, 1)
        # Price and indicator move apart; without an earlier turning point there is no divergence.
        apart = (sign * (F.col(price) - F.col("__pp")) > 0) & (sign * (F.col("macd") - F.col("__pm")) < 0)
        at = F.col(f"{side}_known_at" if known else time)
        one = points.select(symbol, at.alias(time), F.lit(0).alias("__bar"), F.when(apart, 1).otherwise(0).alias(name))
        marks = one if marks is None else marks.unionByName(one, allowMissingColumns=True)
    seen = running(
        marks.unionByName(bars, allowMissingColumns=True), [symbol], [time, "__bar"],
        {"__bull": ("last", F.col("bullish")), "__bear": ("last", F.col("bearish"))},
    )
    state = seen.filter("__bar = 1").select(
        symbol, time, F.coalesce("__bull", F.lit(0)).alias("bullish"), F.coalesce("__bear", F.lit(0)).alias("bearish")
    )
    return df.join(state, [symbol, time])


def minimum_signals(df: DataFrame, symbol: str, time: str, diff: str = "diff", close: str = "close") -> DataFrame:
    """Minima of ``diff`` at least 20 % above the one before while the price is lower.

    Expects ``diff`` from ``macd``. A previous minimum of 0 gives no signal.
    """
    minima = local_minima(df, [symbol], time, diff).filter("is_min = 1").drop("is_min")
    minima = bounded(
        minima, [symbol], [time],
        {"prev_diff": lambda w: F.lag(diff).over(w), "prev_close": lambda w: F.lag(close).over(w)}, 1,
    )
    rise = maths.share(F.col(diff) - F.col("prev_diff"), F.abs("prev_diff"))
    return minima.filter((rise >= RISE_OF_MINIMUM) & (F.col(close) < F.col("prev_close")))


def check_signals(bars: DataFrame, fine: DataFrame, signals: DataFrame, symbol: str, time: str) -> DataFrame:
    """Signals with ``accepted``: no later low clearly under the signal's close.

    Such a low still passes when it is not under the lowest fine-grained close
    of the signal's day.
    """
    later = following(
        bars.select(symbol, time, "close"), [symbol], [time], {"later_low": ("min", F.col("close"))}, include_current=False
    ).drop("close")
    out = signals.join(later, [symbol, time], "left")
    out = day_low(out, fine, symbol, time, "close")
    low = F.lit(LOW_BUFFER) * F.col("later_low")
    broken = (low < F.col("close")) & (low < F.col("day_low"))
    return out.withColumn("accepted", F.when(broken, 0).otherwise(1))


def pivot_scan(
    times: Sequence[int], closes: Sequence[float], ends: bool, limit: float, state: dict | None = None
) -> tuple[list[tuple[int, float]], dict]:
    """Pivots found while reading one stretch of closes, and the state after it.

    ``ends`` tells that the stretch holds the series' last bar.
    """
    s = dict(state) if state else {"dir": 0, "hi": None, "lo": None, "hi_at": None, "lo_at": None, "out_at": None}
    found: list[tuple[int, float]] = []

    def emit(at: int, price: float) -> None:
        if s["out_at"] != at:
            found.append((at, price))
            s["out_at"] = at

    for t, p in zip(times, closes):
        if s["hi"] is None:  # the first bar is a pivot
            s.update(hi=p, lo=p, hi_at=t, lo_at=t)
            emit(t, p)
        if s["dir"] >= 0 and p > s["hi"]:
            s.update(hi=p, hi_at=t)
        if s["dir"] <= 0 and p < s["lo"]:
            s.update(lo=p, lo_at=t)
        fallen, risen = p <= s["hi"] * (1 - limit) and p < s["hi"], p >= s["lo"] * (1 + limit) and p > s["lo"]
        if s["dir"] == 0:
            s["dir"] = -1 if fallen else 1 if risen else 0
            s.update({"lo": p, "lo_at": t} if fallen else {"hi": p, "hi_at": t} if risen else {})
        elif s["dir"] == 1 and fallen:
            emit(s["hi_at"], s["hi"])
            s.update(dir=-1, lo=p, lo_at=t)
        elif s["dir"] == -1 and risen:
            emit(s["lo_at"], s["lo"])
            s.update(dir=1, hi=p, hi_at=t)
    if ends and s["hi"] is not None:  # the open extreme and the last bar close the line
        if s["dir"] != 0:
            emit(*((s["hi_at"], s["hi"]) if s["dir"] == 1 else (s["lo_at"], s["lo"])))
        emit(t, p)
    return found, s


def _turns(closes: np.ndarray) -> np.ndarray:
    """Places where the direction changes (of equal closes the first), and both ends."""
    fresh = np.concatenate([[0], np.flatnonzero(np.diff(closes)) + 1])
    way = np.sign(np.diff(closes[fresh]))
    inner = fresh[1:-1][way[1:] != way[:-1]] if len(fresh) > 2 else fresh[:0]
    return np.unique(np.concatenate([[0], inner, fresh[-1:], [len(closes) - 1]]))


def without_ripples(points: list[tuple[int, float]], limit: float) -> list[tuple[int, float]]:
    """Turning points without those that can't count at ``limit`` or above, whatever came before.

    A dip and the rise to it go where the way up goes on beyond both and the dip is no reversal by
    ``limit``; likewise on the way down. One pass with a stack.
    """
    kept: list[tuple[int, float]] = []
    for point in points:
        kept.append(point)
        while len(kept) > 3:
            w, x, y, z = kept[-4][1], kept[-3][1], kept[-2][1], kept[-1][1]
            dip = w <= y < x < z and y > x * (1 - limit)
            bump = w >= y > x > z and y < x * (1 + limit)
            if not (dip or bump):
                break
            del kept[-3:-1]
    return kept


def _settled(points: list[tuple[int, float]], limit: float) -> int | None:
    """The first point that lies a reversal below an earlier one.

    From there on pivots don't depend on what came before the points: whoever was looking for a
    low has it there, and whoever was looking for a high has just turned.
    """
    top = -math.inf
    for i, (_, p) in enumerate(points):
        if p <= top * (1 - limit) and p < top:
            return i
        top = max(top, p)
    return None


def _each_limit(pdf: pd.DataFrame, limits: Sequence[float]) -> Iterator[tuple[float, list[tuple[int, float]]]]:
    """Turning points of a block for each limit, fewer with each."""
    pdf = pdf.sort_values("__rn")
    times, closes = pdf["__time"].to_numpy(), pdf["close"].to_numpy()
    at = _turns(closes)
    points = list(zip(times[at].tolist(), closes[at].tolist(), strict=True))
    for limit in limits:
        points = without_ripples(points, limit)
        yield limit, points


def _pivots(df: DataFrame, symbol: str, time: str, thresholds: Sequence[float], block_rows: int | None = None) -> DataFrame:
    """Pivots for every threshold: ``symbol``, ``threshold``, ``time``, ``close``, ``pivot_no``.

    Bars are read once for all thresholds. Symbols are cut into blocks that are worked on side by
    side: within a block the first fall by a threshold settles what follows, so most blocks
    know what they leave to the next; those without such a fall get it from the
    block before, one after the other. Then every block is read with what enters it. Bars without a close are no bars.
    """
    spark = df.sparkSession
    limits = sorted({float(t) for t in thresholds})
    size = block_rows or max_group_rows(spark)
    closes = F.col("close").cast("double")
    rows = df.select(symbol, F.unix_micros(F.col(time).cast("timestamp")).alias("__time"), closes.alias("close"))
    rows = number_rows(rows.where(F.col("close").isNotNull() & ~F.isnan("close")), [symbol], ["__time", "close"], "__rn")
    rows = stage(rows.withColumn("__block", F.floor((F.col("__rn") - 1) / F.lit(size)).cast("int")))
    ends = rows.groupBy(symbol).agg(F.max("__rn").alias("__size"), F.max("__block").alias("__blocks"))
    key = T.StructField(symbol, rows.schema[symbol].dataType)
    state_schema = T.StructType([key, T.StructField("__block", T.IntegerType()), T.StructField("threshold", T.DoubleType()), T.StructField("state", T.StringType())])
    names = [symbol, "__block"]

    def leave(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """What a block leaves to the next one, null where that hangs on the one before."""
        out = []
        for limit, points in _each_limit(pdf, limits):
            at = None if key[1] == 0 else _settled(points, limit)
            state = None
            if key[1] == 0:
                state = pivot_scan(*zip(*points, strict=True), False, limit)[1]
            elif at is not None:
                t, p = points[at]
                state = {"dir": -1, "hi": p, "lo": p, "hi_at": t, "lo_at": t, "out_at": None}
                if at + 1 < len(points):
                    state = pivot_scan(*zip(*points[at + 1 :], strict=True), False, limit, state)[1]
            out.append((*key, limit, None if state is None else json.dumps(state)))
        return pd.DataFrame(out, columns=state_schema.names)

    def pass_on(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """States after a block for the thresholds that it doesn't settle, from those before it."""
        entering = dict(zip(right["threshold"], right["state"], strict=True))
        out = []
        for limit, points in _each_limit(left, limits) if len(left) else ():
            if limit in entering:
                out.append((*key, limit, json.dumps(pivot_scan(*zip(*points, strict=True), False, limit, json.loads(entering[limit]))[1])))
        return pd.DataFrame(out, columns=state_schema.names)

    states = spark.createDataFrame([], state_schema)
    several = join_on(rows, ends.where("__blocks > 0"), [symbol], "inner").where("__block < __blocks").select(*rows.columns)
    if not ends.where("__blocks > 0").isEmpty():
        known = stage(several.groupBy(*names).applyInPandas(leave, state_schema))
        states, waiting = known.where("state is not null"), known.where("state is null").drop("state")
        while not waiting.isEmpty():
            before = states.withColumn("__block", F.col("__block") + 1)
            due = stage(join_on(waiting, before, [*names, "threshold"], "inner"))
            here = join_on(several, due.select(*names).distinct(), names, "left_semi")
            done = stage(here.groupBy(*names).cogroup(due.groupBy(*names)).applyInPandas(pass_on, state_schema))
            states = states.unionByName(done)
            waiting = stage(join_on(waiting, done.drop("state"), [*names, "threshold"], "left_anti"))

    out_schema = T.StructType([key, T.StructField("threshold", T.DoubleType()), T.StructField("__time", T.LongType()), T.StructField("close", T.DoubleType())])

    def read(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        entering = {t: json.loads(s) for t, s in zip(right["threshold"], right["state"], strict=True)}
        out: list[tuple] = []
        if len(left):
            last = bool((left["__rn"] == left["__size"]).any())
            for limit, points in _each_limit(left, limits):
                found, _ = pivot_scan(*zip(*points, strict=True), last, limit, entering.get(limit))
                out += [(key[0], limit, t, p) for t, p in found]
        return pd.DataFrame(out, columns=out_schema.names)

    sized = join_on(rows, ends.drop("__blocks"), [symbol], "left")
    entering = states.withColumn("__block", F.col("__block") + 1)
    found = stage(sized.groupBy(*names).cogroup(entering.groupBy(*names)).applyInPandas(read, out_schema))
    found = found.select(symbol, "threshold", F.timestamp_micros("__time").alias(time), "close")
    numbered = number_rows(found, [symbol, "threshold"], [time], "pivot_no")
    return numbered.withColumn("pivot_no", F.col("pivot_no") - 1)


def zigzag(df: DataFrame, symbol: str, time: str, threshold: float = REVERSAL, block_rows: int | None = None) -> DataFrame:
    """Pivots of the close: the first bar, each extreme later reversed by the threshold, and the end.

    One row per pivot with ``pivot_no`` from 0. The price has to turn by the
    threshold from the running extreme. The open extreme at the end and the last
    bar close the line.
    """
    return _pivots(df, symbol, time, [threshold], block_rows).drop("threshold")


def threshold_sweep(df: DataFrame, symbol: str, time: str, thresholds: Sequence[float], block_rows: int | None = None) -> DataFrame:
    """Pivots for every threshold, from one reading of the bars."""
    return _pivots(df, symbol, time, thresholds, block_rows)


def zigzag_line(df: DataFrame, pivots: DataFrame, symbol: str, time: str) -> DataFrame:
    """The straight line between neighbouring pivots at every bar."""
    marks = pivots.select(symbol, time, F.struct(F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col("close").alias("p")).alias("__p"))
    bars = df.select(symbol, time, "close").join(marks, [symbol, time], "left")
    out = running(bars, [symbol], [time], {"__a": ("last", F.col("__p"))})
    out = following(out, [symbol], [time], {"__b": ("last", F.col("__p"))})
    a, b = F.col("__a"), F.col("__b")
    part = maths.share((F.unix_micros(F.col(time).cast("timestamp")) - a["t"]).cast("double"), b["t"] - a["t"])
    line = a["p"] + F.coalesce(part, F.lit(0.0)) * (b["p"] - a["p"])
    return out.select(symbol, time, "close", line.alias("line"))


def split_pivots(pivots: DataFrame, symbol: str, time: str) -> DataFrame:
    """Pivots labelled high and low by alternation.

    The first is skipped; symbols with fewer than four pivots drop out. Odd ones
    are lows when the second pivot lies under the third.
    """
    at = lambda n: F.max(F.when(F.col("pivot_no") == n, F.col("close")))
    out = attach(pivots, [symbol], {"__n": F.count(F.lit(1)), "__one": at(1), "__two": at(2)})
    odd_low = F.col("__one") < F.col("__two")
    kind = F.when((F.col("pivot_no") % 2 == 1) == odd_low, "low").otherwise("high")
    return (
        out.filter((F.col("__n") >= 4) & (F.col("pivot_no") > 0))
        .withColumn("kind", kind)
        .select(symbol, time, "close", "pivot_no", "kind")
    )


def buy_points(signals: DataFrame, pivots: DataFrame, symbol: str, time: str) -> DataFrame:
    """First low pivot at or after each signal that lies above the first high pivot at or after it.

    Pivots carry ``kind`` from ``split_pivots``. Signals without one drop out.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    sig = signals.select(symbol, F.col(time).alias("signal_time"))
    p = pivots.select(symbol, F.col(time).alias("__pt"), F.col("close").alias("__pc"), "kind")
    highs, lows = p.filter("kind = 'high'").drop("kind"), p.filter("kind = 'low'").drop("kind")
    marked = asof(sig, highs, [symbol], "signal_time", "__pt", ["__pc"], "forward")
    marked = marked.select(symbol, "signal_time", F.col("matched___pc").alias("high_close")).filter("high_close is not null")
    asked = marked.withColumn("after", micros("signal_time")).withColumn("bound", F.col("high_close"))
    found = first_above(lows.withColumn("__pt", micros("__pt")), symbol, "__pt", "__pc", asked)
    return found.select(
        symbol, "signal_time", "high_close", F.timestamp_micros("found_order").cast(pivots.schema[time].dataType).alias("buy_time"),
        F.col("found_value").alias("buy_close"),
    )


def trend_segments(df: DataFrame, symbol: str, time: str) -> DataFrame:
    """Lines between neighbouring turning points, merged while they keep their direction."""
    tops = df.filter("is_top = 1").select(symbol, time, F.lit(0).alias("__o"), F.col("high").alias("price"))
    points = tops.unionByName(df.filter("is_bottom = 1").select(symbol, time, F.lit(1).alias("__o"), F.col("low").alias("price")))
    points = points.withColumn("__at", F.struct(time, "__o"))
    parts = bounded(
        points, [symbol], ["__at"],
        {"from_time": lambda w: F.lag(time).over(w), "from_price": lambda w: F.lag("price").over(w)}, 1,
    ).filter("from_time is not null")
    parts = parts.withColumn("direction", F.when(F.col("price") > F.col("from_price"), "up").otherwise("down"))
    parts = parts.withColumnsRenamed({time: "to_time", "price": "to_price"})
    return merge_runs(parts, [symbol], "__at", "direction", ["from_time", "from_price"], ["to_time", "to_price"])


def stable_values(full: DataFrame, part: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per column how many rows of ``part`` have the same value in ``full``."""
    other = full.select(*keys, *[F.col(c).alias(f"__f_{c}") for c in cols])
    both = part.select(*keys, *cols).join(other, list(keys))
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).eqNullSafe(F.col(f"__f_{c}")).alias("same")) for c in cols]
    )
    return both.select(F.inline(cells)).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("same").alias("n_same")
    )
