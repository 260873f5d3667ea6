"""Indicators, signals, replays and portfolios over hourly bars."""

from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import portfolio, series, trading
from millrace.operators import windows as win
from millrace.plans.registry import query
from millrace.plans.tables import BARS, bars, table

_ID = "symbol, CAST(epoch(ts) AS BIGINT) AS ts"


def _out(df, *cols, digits=6):
    kinds = dict(df.dtypes)
    return df.select(
        "symbol", F.unix_timestamp("ts").alias("ts"),
        *[
            F.round(c, digits).alias(c) if kinds[c] == "double"
            else F.unix_timestamp(c).alias(c) if kinds[c] == "timestamp" else F.col(c)
            for c in cols
        ],
    )


def _ema_sql(weighted: bool, spans: tuple[int, int, int]) -> str:
    """Recursive averages over numbered bars."""
    s, l, m = (f"(2.0::DOUBLE / {n + 1})" for n in spans)
    price = "((high + low) / 2 + close) / 2" if weighted else "close"
    return f"""n AS MATERIALIZED (SELECT *, {price} AS x, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k FROM bars),
    r AS (SELECT symbol, ts, k, x AS a, x AS b, 0.0::DOUBLE AS dea FROM n WHERE k = 1
      UNION ALL SELECT n.symbol, n.ts, n.k, {s} * n.x + (1 - {s}) * r.a, {l} * n.x + (1 - {l}) * r.b,
        {m} * (({s} * n.x + (1 - {s}) * r.a) - ({l} * n.x + (1 - {l}) * r.b)) + (1 - {m}) * r.dea
      FROM r JOIN n ON n.symbol = r.symbol AND n.k = r.k + 1),
    i AS MATERIALIZED (SELECT n.*, r.a - r.b AS diff, r.dea, 2 * (r.a - r.b - r.dea) AS macd FROM n JOIN r ON n.symbol = r.symbol AND n.k = r.k)"""


_WEIGHTED = f"RECURSIVE {BARS}, {_ema_sql(True, series.WEIGHTED_SPANS)}"
_CLASSIC = f"RECURSIVE {BARS}, {_ema_sql(False, series.CLASSIC_SPANS)}"


@query("adjusted_close", f"WITH {BARS} SELECT {_ID}, round(close + dividends, 6) AS adjusted FROM bars")
def adjusted_close(spark, sf):
    return _out(series.adjusted_close(bars(spark, sf)), "adjusted")


@query("macd", f"WITH {_WEIGHTED} SELECT {_ID}, round(diff, 6) AS diff, round(dea, 6) AS dea, round(macd, 6) AS macd FROM i")
def macd(spark, sf):
    return _out(series.macd(bars(spark, sf), "symbol", "ts"), "diff", "dea", "macd")


@query("classic_macd", f"WITH {_CLASSIC} SELECT {_ID}, round(diff, 6) AS diff, round(dea, 6) AS dea, round(macd, 6) AS macd FROM i")
def classic_macd(spark, sf):
    return _out(series.macd(bars(spark, sf), "symbol", "ts", weighted=False), "diff", "dea", "macd")


_CROSSES = """c AS (SELECT *, CASE WHEN lag(diff) OVER w <= lag(dea) OVER w AND diff > dea THEN 1 ELSE 0 END AS golden,
      CASE WHEN lag(dea) OVER w <= lag(diff) OVER w AND dea > diff THEN 1 ELSE 0 END AS dead FROM i WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
    f AS (SELECT *, CASE WHEN lag(golden, 3) OVER w = 1 AND min(CASE WHEN diff > dea THEN 1 ELSE 0 END) OVER h = 1 THEN 1 ELSE 0 END AS golden_confirmed,
      CASE WHEN lag(dead, 3) OVER w = 1 AND min(CASE WHEN dea > diff THEN 1 ELSE 0 END) OVER h = 1 THEN 1 ELSE 0 END AS dead_confirmed
      FROM c WINDOW w AS (PARTITION BY symbol ORDER BY ts), h AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


def _crosses(spark, sf):
    return series.crosses(series.macd(bars(spark, sf), "symbol", "ts"), "symbol", "ts")


@query("crosses", f"WITH {_WEIGHTED}, {_CROSSES} SELECT {_ID}, golden, dead, golden_confirmed, dead_confirmed FROM f")
def crosses(spark, sf):
    return _out(_crosses(spark, sf), "golden", "dead", "golden_confirmed", "dead_confirmed")


_TURNS = f"""{_CROSSES}, b AS (SELECT *, max(dead_confirmed) OVER n AS t, max(golden_confirmed) OVER n AS u,
      min(CASE WHEN dead_confirmed = 1 THEN ts END) OVER n AS top_known_at, min(CASE WHEN golden_confirmed = 1 THEN ts END) OVER n AS bottom_known_at
      FROM f WINDOW n AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
    p AS MATERIALIZED (SELECT *, CASE WHEN lag(t) OVER w = 0 AND t = 1 THEN 1 ELSE 0 END AS is_top,
      CASE WHEN lag(u) OVER w = 0 AND u = 1 THEN 1 ELSE 0 END AS is_bottom FROM b WINDOW w AS (PARTITION BY symbol ORDER BY ts))"""


def _turns(spark, sf):
    return series.turning_points(_crosses(spark, sf), "symbol", "ts")


@query(
    "turning_points",
    f"""WITH {_WEIGHTED}, {_TURNS} SELECT {_ID}, is_top, is_bottom, CAST(epoch(top_known_at) AS BIGINT) AS top_known_at,
    CAST(epoch(bottom_known_at) AS BIGINT) AS bottom_known_at FROM p""",
)
def turning_points(spark, sf):
    return _out(_turns(spark, sf), "is_top", "is_bottom", "top_known_at", "bottom_known_at")


_DIV = f"""{_TURNS}, lo AS (SELECT symbol, ts, CASE WHEN low < lag(low) OVER w AND macd > lag(macd) OVER w THEN 1 ELSE 0 END AS hit
      FROM p WHERE is_bottom = 1 WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
    hi AS (SELECT symbol, ts, CASE WHEN high > lag(high) OVER w AND macd < lag(macd) OVER w THEN 1 ELSE 0 END AS hit
      FROM p WHERE is_top = 1 WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
    v AS (SELECT p.symbol, p.ts, coalesce(last_value(lo.hit IGNORE NULLS) OVER w, 0) AS bullish, coalesce(last_value(hi.hit IGNORE NULLS) OVER w, 0) AS bearish
      FROM p LEFT JOIN lo ON p.symbol = lo.symbol AND p.ts = lo.ts LEFT JOIN hi ON p.symbol = hi.symbol AND p.ts = hi.ts
      WINDOW w AS (PARTITION BY p.symbol ORDER BY p.ts))"""


def _flags(spark, sf):
    return series.divergence_flags(_turns(spark, sf), "symbol", "ts")


@query("divergence_flags", f"WITH {_WEIGHTED}, {_DIV} SELECT {_ID}, bullish, bearish FROM v")
def divergence_flags(spark, sf):
    return _out(_flags(spark, sf), "bullish", "bearish")


_SIGNALS = """d AS (SELECT *, sign(lead(diff) OVER w - diff) AS after, sign(diff - lag(diff) OVER w) AS b0 FROM i WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
    m AS (SELECT *, lag(diff) OVER w AS prev_diff, lag(close) OVER w AS prev_close FROM d WHERE after > coalesce(b0, after) WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
    s AS (SELECT * FROM m WHERE (diff - prev_diff) / nullif(abs(prev_diff), 0) >= 0.2 AND close < prev_close)"""


def _signals(spark, sf):
    return series.minimum_signals(series.macd(bars(spark, sf), "symbol", "ts", weighted=False), "symbol", "ts")


@query("minimum_signals", f"WITH {_CLASSIC}, {_SIGNALS} SELECT {_ID}, round(diff, 6) AS diff, round(prev_diff, 6) AS prev_diff, round(close, 6) AS close FROM s")
def minimum_signals(spark, sf):
    return _out(_signals(spark, sf), "diff", "prev_diff", "close")


_CHECKED = f"""{_SIGNALS}, l AS (SELECT symbol, ts, min(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later_low,
      min(close) OVER (PARTITION BY symbol, CAST(ts AS DATE)) AS day_low FROM bars)"""


@query(
    "checked_signals",
    f"""WITH {_CLASSIC}, {_CHECKED} SELECT s.symbol, CAST(epoch(s.ts) AS BIGINT) AS ts, round(later_low, 6) AS later_low, round(day_low, 6) AS day_low,
    CASE WHEN 1.005 * later_low < s.close AND 1.005 * later_low < day_low THEN 0 ELSE 1 END AS accepted FROM s JOIN l ON s.symbol = l.symbol AND s.ts = l.ts""",
)
def checked_signals(spark, sf):
    b = bars(spark, sf)
    return _out(series.check_signals(b, b, _signals(spark, sf), "symbol", "ts"), "later_low", "day_low", "accepted")


def _split(spark, sf, threshold=0.3):
    # Event values swing far more than prices, hence a wider reversal.
    return series.split_pivots(series.zigzag(bars(spark, sf), "symbol", "ts", threshold), "symbol", "ts")


def _zigzag_sql(thresholds):
    """Pivots ``pv`` (symbol, h, ts, close, pivot_no) of ``bars`` for each threshold, bar by bar."""
    values = ", ".join(f"({t!r}::DOUBLE)" for t in thresholds)
    return f"""zn AS MATERIALIZED (SELECT symbol, h, ts, CAST(close AS DOUBLE) AS close, row_number() OVER (PARTITION BY symbol, h ORDER BY ts) AS k
      FROM bars, (VALUES {values}) t(h)),
    zs AS (SELECT symbol, h, k, 0 AS dir, close AS hi, close AS lo, k AS hik, k AS lok, k AS found FROM zn WHERE k = 1
      UNION ALL SELECT symbol, h, k,
        CASE WHEN dir >= 0 AND fallen THEN -1 WHEN dir <= 0 AND risen THEN 1 ELSE dir END,
        CASE WHEN dir <= 0 AND risen AND NOT (dir = 0 AND fallen) THEN p ELSE hi END,
        CASE WHEN dir >= 0 AND fallen THEN p ELSE lo END,
        CASE WHEN dir <= 0 AND risen AND NOT (dir = 0 AND fallen) THEN k ELSE hik END,
        CASE WHEN dir >= 0 AND fallen THEN k ELSE lok END,
        CASE WHEN dir = 1 AND fallen THEN hik WHEN dir = -1 AND risen THEN lok END
      FROM (SELECT *, p <= hi * (1 - h) AND p < hi AS fallen, p >= lo * (1 + h) AND p > lo AS risen FROM (
        SELECT zn.symbol, zn.h, zn.k, zn.close AS p, zs.dir,
          CASE WHEN zs.dir >= 0 AND zn.close > zs.hi THEN zn.close ELSE zs.hi END AS hi, CASE WHEN zs.dir >= 0 AND zn.close > zs.hi THEN zn.k ELSE zs.hik END AS hik,
          CASE WHEN zs.dir <= 0 AND zn.close < zs.lo THEN zn.close ELSE zs.lo END AS lo, CASE WHEN zs.dir <= 0 AND zn.close < zs.lo THEN zn.k ELSE zs.lok END AS lok
        FROM zs JOIN zn ON zn.symbol = zs.symbol AND zn.h = zs.h AND zn.k = zs.k + 1))),
    zl AS (SELECT symbol, h, arg_max(dir, k) AS dir, arg_max(hik, k) AS hik, arg_max(lok, k) AS lok, max(k) AS k FROM zs GROUP BY symbol, h),
    zp AS (SELECT symbol, h, found AS k FROM zs WHERE found IS NOT NULL UNION SELECT symbol, h, CASE dir WHEN 1 THEN hik ELSE lok END FROM zl WHERE dir <> 0
      UNION SELECT symbol, h, k FROM zl),
    pv AS MATERIALIZED (SELECT symbol, h, zn.ts, zn.close, row_number() OVER (PARTITION BY symbol, h ORDER BY zn.ts) - 1 AS pivot_no FROM zp JOIN zn USING (symbol, h, k))"""


@query("zigzag_pivots", f"WITH RECURSIVE {BARS}, {_zigzag_sql([series.REVERSAL])} SELECT {_ID}, round(close, 6) AS close, pivot_no FROM pv")
def zigzag_pivots(spark, sf):
    return _out(series.zigzag(bars(spark, sf), "symbol", "ts"), "close", "pivot_no")


@query(
    "zigzag_line",
    f"""WITH RECURSIVE {BARS}, {_zigzag_sql([0.3])},
    m AS (SELECT b.symbol, b.ts, b.close, max(pv.ts) OVER p AS t0, min(pv.ts) OVER q AS t1 FROM bars b LEFT JOIN pv ON pv.symbol = b.symbol AND pv.ts = b.ts
      WINDOW p AS (PARTITION BY b.symbol ORDER BY b.ts), q AS (PARTITION BY b.symbol ORDER BY b.ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT m.symbol, CAST(epoch(m.ts) AS BIGINT) AS ts, round(m.close, 6) AS close,
    round(a.close + coalesce((epoch_us(m.ts) - epoch_us(t0))::DOUBLE / nullif(epoch_us(t1) - epoch_us(t0), 0), 0) * (z.close - a.close), 6) AS line
    FROM m JOIN pv a ON a.symbol = m.symbol AND a.ts = t0 JOIN pv z ON z.symbol = m.symbol AND z.ts = t1""",
)
def zigzag_line(spark, sf):
    b = bars(spark, sf)
    return _out(series.zigzag_line(b, series.zigzag(b, "symbol", "ts", 0.3), "symbol", "ts"), "close", "line")


_SWEEP = [i / 1000 for i in range(51)]


@query("threshold_sweep", f"WITH RECURSIVE {BARS}, {_zigzag_sql(_SWEEP)} SELECT symbol, h AS threshold, count(*) AS pivots FROM pv GROUP BY symbol, h")
def threshold_sweep(spark, sf):
    pivots = series.threshold_sweep(bars(spark, sf), "symbol", "ts", _SWEEP)
    return pivots.groupBy("symbol", "threshold").agg(F.count(F.lit(1)).alias("pivots"))


_SPLIT = f"""{_zigzag_sql([0.3])},
    ps AS (SELECT symbol, count(*) AS n, max(CASE WHEN pivot_no = 1 THEN close END) AS one, max(CASE WHEN pivot_no = 2 THEN close END) AS two FROM pv GROUP BY symbol),
    sp AS MATERIALIZED (SELECT pv.symbol, ts, close, pivot_no, CASE WHEN (pivot_no % 2 = 1) = (one < two) THEN 'low' ELSE 'high' END AS kind
      FROM pv JOIN ps USING (symbol) WHERE n >= 4 AND pivot_no > 0)"""


@query("split_pivots", f"WITH RECURSIVE {BARS}, {_SPLIT} SELECT {_ID}, round(close, 6) AS close, pivot_no, kind FROM sp")
def split_pivots(spark, sf):
    return _out(_split(spark, sf), "close", "pivot_no", "kind")


@query(
    "buy_points",
    f"""WITH {_CLASSIC}, {_SIGNALS}, {_SPLIT},
    hs AS (SELECT s.symbol, s.ts AS signal, arg_min(sp.close, sp.ts) AS high_close FROM s JOIN sp ON sp.symbol = s.symbol AND sp.kind = 'high' AND sp.ts >= s.ts GROUP BY 1, 2)
    SELECT hs.symbol, CAST(epoch(signal) AS BIGINT) AS signal_time, round(high_close, 6) AS high_close, CAST(epoch(min(sp.ts)) AS BIGINT) AS buy_time,
    round(arg_min(sp.close, sp.ts), 6) AS buy_close
    FROM hs JOIN sp ON sp.symbol = hs.symbol AND sp.kind = 'low' AND sp.ts >= signal AND sp.close > high_close GROUP BY hs.symbol, signal, high_close""",
)
def buy_points(spark, sf):
    out = series.buy_points(_signals(spark, sf), _split(spark, sf), "symbol", "ts")
    return out.select(
        "symbol", F.unix_timestamp("signal_time").alias("signal_time"), F.round("high_close", 6).alias("high_close"),
        F.unix_timestamp("buy_time").alias("buy_time"), F.round("buy_close", 6).alias("buy_close"),
    )


def _sightings(spark, sf, window, age):
    found = trading.replay_windows(bars(spark, sf), "symbol", "ts", window, age)
    return trading.second_sightings(found, "symbol").withColumn("window", F.lit(window))


@query("replayed_buy_points")
def replayed_buy_points(spark, sf):
    found = _sightings(spark, sf, *trading.SEVEN_A_DAY).unionByName(_sightings(spark, sf, *trading.ROUND_THE_CLOCK))
    return found.select("window", "symbol", "buy_time", F.size("seen").alias("seen"), "entry_time")


def _stop_entries(spark, sf):
    return _signals(spark, sf).select("symbol", "ts")


_D = lambda x: f"{x!r}::DOUBLE"


@query(
    "trailing_stops",
    f"""WITH {_CLASSIC}, {_SIGNALS},
    tb AS MATERIALIZED (SELECT symbol, ts, CAST(close AS DOUBLE) AS close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k, count(*) OVER (PARTITION BY symbol) AS n FROM bars),
    tr AS (SELECT tb.symbol, tb.k AS k0, tb.ts AS t0, tb.close AS p0, tb.k, tb.ts, tb.close AS p, tb.n, tb.close * {_D(trading.STOP)} AS stop, {_D(trading.STOP)} AS coeff,
        tb.close AS high, tb.close * {_D(trading.RISE_STEP)} AS step, NULL::DOUBLE AS booked, 0 AS sold FROM tb JOIN s ON s.symbol = tb.symbol AND s.ts = tb.ts
      UNION ALL SELECT symbol, k0, t0, p0, k, ts, p, n, CASE WHEN up THEN p * coeff2 ELSE stop END, coeff2, CASE WHEN up THEN p ELSE high END,
        CASE WHEN up AND p > step THEN step * {_D(trading.RISE_STEP)} ELSE step END, booked2, CASE WHEN p < stop THEN 1 ELSE 0 END
      FROM (SELECT *, NOT p < stop AND p > high AS up,
          CASE WHEN NOT p < stop AND p > high AND p > step THEN greatest({_D(trading.STOP_FLOOR)}, coeff - {_D(trading.STOP_STEP)}) ELSE coeff END AS coeff2,
          CASE WHEN booked IS NULL AND p > p0 * {_D(trading.HALF_SELL)} THEN (p - p0) / p0 ELSE booked END AS booked2
        FROM (SELECT tr.symbol, tr.k0, tr.t0, tr.p0, tb.k, tb.ts, tb.close AS p, tr.n, tr.stop, tr.coeff, tr.high, tr.step, tr.booked
          FROM tr JOIN tb ON tb.symbol = tr.symbol AND tb.k = tr.k + 1 WHERE tr.sold = 0)))
    SELECT symbol, CAST(epoch(t0) AS BIGINT) AS entry_time, round(p0, 6) AS entry_price, CAST(epoch(ts) AS BIGINT) AS exit_time, round(p, 6) AS exit_price,
    round(CASE WHEN booked IS NULL THEN (p - p0) / p0 ELSE 0.5 * booked + 0.5 * ((p - p0) / p0) END, 6) AS ret, sold AS stopped
    FROM tr WHERE k > k0 AND (sold = 1 OR k = n)""",
)
def trailing_stops(spark, sf):
    out = trading.trailing_stops(bars(spark, sf), _stop_entries(spark, sf), "symbol", "ts")
    return out.select(
        "symbol", F.unix_timestamp("entry_time").alias("entry_time"), F.round("entry_price", 6).alias("entry_price"),
        F.unix_timestamp("exit_time").alias("exit_time"), F.round("exit_price", 6).alias("exit_price"), F.round("ret", 6).alias("ret"), "stopped",
    )


_PLAIN_STOPS = f"""WITH {_CLASSIC}, {_SIGNALS},
    j AS (SELECT s.symbol, s.ts AS t0, s.close AS p0, b.ts, b.close,
      0.94 * greatest(s.close, coalesce(max(b.close) OVER (PARTITION BY s.symbol, s.ts ORDER BY b.ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s.close)) AS stop,
      max(b.ts) OVER (PARTITION BY s.symbol, s.ts) AS last_ts FROM s JOIN bars b ON b.symbol = s.symbol AND b.ts > s.ts)
    SELECT symbol, CAST(epoch(t0) AS BIGINT) AS entry_time, CAST(epoch(min(ts)) AS BIGINT) AS exit_time,
    (arg_min(close, ts) - p0) / p0 AS ret FROM j WHERE close < stop OR ts = last_ts GROUP BY symbol, t0, p0"""


@query("plain_trailing_stops", f"WITH t AS ({_PLAIN_STOPS}) SELECT symbol, entry_time, exit_time, round(ret, 6) AS ret FROM t")
def plain_trailing_stops(spark, sf):
    out = trading.trailing_stops(bars(spark, sf), _stop_entries(spark, sf), "symbol", "ts", half_sell=False)
    return out.select(
        "symbol", F.unix_timestamp("entry_time").alias("entry_time"), F.unix_timestamp("exit_time").alias("exit_time"), F.round("ret", 6).alias("ret")
    )


@query("mean_trade_return", f"WITH t AS ({_PLAIN_STOPS}) SELECT symbol, round(avg(ret), 4) AS mean, count(ret) AS n FROM t GROUP BY symbol")
def mean_trade_return(spark, sf):
    out = trading.trailing_stops(bars(spark, sf), _stop_entries(spark, sf), "symbol", "ts", half_sell=False)
    return agg.mean_by(out, ["symbol"], "ret").withColumn("mean", F.round("mean", 4))


def _side_sql(name: str, sign: int, turn: str, push: str, against: str) -> tuple[str, str]:
    """A book's step from bar to bar: whether it opens or closes, then its state and action."""
    gain = f"({sign} * (p - {name}_entry))"
    due = f"""({against} <> 0 OR (us - {name}_at) // 86400000000 > {trading.TIME_STOP_DAYS}
        OR {gain} <= -{_D(trading.STOP_LOSS)} * {name}_entry OR {gain} >= {_D(trading.STOP_PROFIT)} * {name}_entry)"""
    marks = f"({name}_entry IS NULL AND {turn} = 1 AND {push} = 1) AS {name}_opens, ({name}_entry IS NOT NULL AND {due}) AS {name}_closes"
    state = f"""CASE WHEN {name}_closes THEN {name}_book + {gain} * {name}_units ELSE {name}_book END,
        CASE WHEN {name}_opens THEN p WHEN NOT {name}_closes THEN {name}_entry END, CASE WHEN {name}_opens THEN us WHEN NOT {name}_closes THEN {name}_at END,
        CASE WHEN {name}_opens THEN {name}_book * {_D(trading.LEVERAGE)} / p WHEN {name}_closes THEN 0 ELSE {name}_units END,
        CASE WHEN {name}_opens THEN {sign} WHEN {name}_closes THEN 0 END"""
    return marks, state


def _books_sql(capital: float = 10_000.0) -> str:
    """Books ``bk`` of both sides, one row per bar, bar by bar."""
    sides = [_side_sql("l", 1, "is_bottom", "bullish", "bearish"), _side_sql("s", -1, "is_top", "bearish", "bullish")]
    empty = ", ".join(f"{_D(capital / 2)} AS {x}_book, NULL::DOUBLE AS {x}_entry, NULL::BIGINT AS {x}_at, 0::DOUBLE AS {x}_units, NULL::INTEGER AS {x}_action" for x in "ls")
    return f"""{_DIV},
    kb AS MATERIALIZED (SELECT p.symbol, p.ts, CAST(p.close AS DOUBLE) AS p, is_bottom, is_top, bullish, bearish, epoch_us(p.ts) AS us, row_number() OVER (PARTITION BY p.symbol ORDER BY p.ts) AS k
      FROM p JOIN v ON p.symbol = v.symbol AND p.ts = v.ts),
    bs AS (SELECT symbol, 0::BIGINT AS k, NULL::TIMESTAMP AS ts, NULL::DOUBLE AS p, {_D(capital)} AS equity_before, {empty} FROM (SELECT DISTINCT symbol FROM kb)
      UNION ALL SELECT symbol, k, ts, p, before, {sides[0][1]}, {sides[1][1]}
      FROM (SELECT *, {sides[0][0]}, {sides[1][0]} FROM (SELECT kb.symbol, kb.k, kb.ts, kb.p, kb.us, is_bottom, is_top, bullish, bearish, l_book + s_book AS before,
        l_book, l_entry, l_at, l_units, s_book, s_entry, s_at, s_units FROM bs JOIN kb ON kb.symbol = bs.symbol AND kb.k = bs.k + 1))),
    bk AS MATERIALIZED (SELECT symbol, ts, p AS close, l_action AS long_action, s_action AS short_action, equity_before, l_book + s_book AS equity FROM bs WHERE k > 0)"""


def _books(spark, sf):
    return trading.divergence_trades(_flags(spark, sf), "symbol", "ts")


@query(
    "divergence_trades",
    f"""WITH {_WEIGHTED}, {_books_sql()} SELECT {_ID}, round(close, 6) AS close, long_action, short_action,
    round(equity_before, 6) AS equity_before, round(equity, 6) AS equity FROM bk""",
)
def divergence_trades(spark, sf):
    return _out(_books(spark, sf), "close", "long_action", "short_action", "equity_before", "equity")


@query(
    "position_log",
    f"""WITH {_WEIGHTED}, {_books_sql()}, a AS (SELECT *, 'long' AS book, long_action AS action FROM bk UNION ALL SELECT *, 'short', short_action FROM bk)
    SELECT {_ID}, round(close, 6) AS price, book, action FROM a WHERE action IS NOT NULL""",
)
def position_log(spark, sf):
    return _out(trading.position_log(_books(spark, sf), "symbol", "ts"), "price", "book", "action")


@query(
    "trading_performance",
    f"""WITH {_WEIGHTED}, {_books_sql()}, pf AS (SELECT symbol, avg(equity / equity_before - 1) AS m, stddev_samp(equity / equity_before - 1) AS s,
      greatest(max(equity), max(equity_before)) AS peak, arg_min(equity_before, ts) AS initial, arg_max(equity, ts) AS final FROM bk GROUP BY symbol)
    SELECT symbol, round(coalesce(m / nullif(s, 0), 0), 6) AS sharpe, round(coalesce((peak - final) / nullif(peak, 0), 0), 6) AS drawdown,
    round(initial, 6) AS initial, round(final, 6) AS final FROM pf""",
)
def trading_performance(spark, sf):
    out = trading.performance(_books(spark, sf), "symbol", "ts")
    return out.select("symbol", *[F.round(c, 6).alias(c) for c in ("sharpe", "drawdown", "initial", "final")])


@query(
    "trend_segments",
    f"""WITH {_WEIGHTED}, {_TURNS}, q AS (SELECT symbol, ts, 0 AS o, high AS price FROM p WHERE is_top = 1 UNION ALL SELECT symbol, ts, 1, low FROM p WHERE is_bottom = 1),
    g AS (SELECT *, lag(ts) OVER w AS t0, lag(price) OVER w AS p0 FROM q WINDOW w AS (PARTITION BY symbol ORDER BY ts, o)),
    h AS (SELECT *, CASE WHEN price > p0 THEN 'up' ELSE 'down' END AS direction FROM g WHERE t0 IS NOT NULL),
    k2 AS (SELECT *, CASE WHEN lag(direction) OVER w IS DISTINCT FROM direction THEN 1 ELSE 0 END AS head FROM h WINDOW w AS (PARTITION BY symbol ORDER BY ts, o)),
    e AS (SELECT *, sum(head) OVER (PARTITION BY symbol ORDER BY ts, o) AS run FROM k2)
    SELECT symbol, CAST(run AS BIGINT) AS run, direction, CAST(epoch(min(t0)) AS BIGINT) AS from_time, CAST(epoch(max(ts)) AS BIGINT) AS to_time,
    round(arg_min(p0, (ts, o)), 6) AS from_price, round(arg_max(price, (ts, o)), 6) AS to_price, count(*) AS merged FROM e GROUP BY symbol, run, direction""",
)
def trend_segments(spark, sf):
    out = series.trend_segments(_turns(spark, sf), "symbol", "ts")
    return out.select(
        "symbol", "run", "direction", F.unix_timestamp("from_time").alias("from_time"), F.unix_timestamp("to_time").alias("to_time"),
        F.round("from_price", 6).alias("from_price"), F.round("to_price", 6).alias("to_price"), "merged",
    )


@query("window_stability")
def window_stability(spark, sf):
    b = bars(spark, sf)
    full = series.macd(b, "symbol", "ts", weighted=False)
    part = series.macd(b.filter(F.col("ts") >= "2024-01-16"), "symbol", "ts", weighted=False)
    return series.stable_values(full, part, ["symbol", "ts"], ["close", "diff", "dea", "macd"])


# Asset classes stand for event types: their daily mean value is the price, a tenth of a percent of it the dividend.
_ASSETS = {"stock": "view", "bond": "click", "long_bond": "purchase", "mid_bond": "signup", "gold": "error", "commodities": "view"}


def _asset_prices(spark, sf):
    names = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg((F.avg("value") + 100).alias("close"))
    pairs = F.array(*[F.struct(F.lit(a).alias("symbol"), F.lit(e).alias("kind")) for a, e in _ASSETS.items()])
    wide = names.select("*", F.inline(pairs)).filter("kind = event_type")
    return wide.select("symbol", "day", "close", (F.col("close") / 1000).alias("dividends"))


_BOOKS = {"sixty_forty": portfolio.SIXTY_FORTY, "all_weather": portfolio.ALL_WEATHER}
_PORTFOLIO = f"""a(symbol, kind) AS (VALUES {", ".join(f"('{a}', '{e}')" for a, e in _ASSETS.items())}),
    w(portfolio, symbol, weight) AS (VALUES {", ".join(f"('{p}', '{s}', {v}::DOUBLE)" for p, b in _BOOKS.items() for s, v in b.items())}),
    c AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) + 100 AS close FROM events GROUP BY 1, 2),
    z AS (SELECT portfolio, day, sum(weight * close) AS price, sum(weight * close / 1000) AS paid, count(*) AS n
      FROM c JOIN a ON kind = event_type JOIN w ON w.symbol = a.symbol GROUP BY 1, 2),
    y AS (SELECT * FROM z WHERE n = (SELECT count(*) FROM w WHERE w.portfolio = z.portfolio)),
    r AS (SELECT portfolio, (lead(price) OVER v - price + paid) / price AS ret FROM y WINDOW v AS (PARTITION BY portfolio ORDER BY day))"""


def _portfolio(spark, sf):
    return portfolio.portfolio_series(_asset_prices(spark, sf), portfolio.weights(spark, _BOOKS), "symbol", "day")


@query("portfolio_series", f"WITH {_PORTFOLIO} SELECT portfolio, CAST(day AS VARCHAR) AS day, round(price, 10) AS price, round(paid, 12) AS paid FROM y")
def portfolio_series(spark, sf):
    out = _portfolio(spark, sf)
    return out.select("portfolio", F.col("day").cast("string").alias("day"), F.round("price", 10).alias("price"), F.round("paid", 12).alias("paid"))


@query(
    "portfolio_stats",
    f"""WITH {_PORTFOLIO} SELECT portfolio, round(avg(ret), 8) AS mean, round(stddev_pop(ret), 8) AS std,
    round(sqrt(252) * avg(ret) / stddev_pop(ret), 6) AS sharpe, round(sqrt(252) * stddev_pop(ret), 6) AS annual_std FROM r GROUP BY portfolio""",
)
def portfolio_stats(spark, sf):
    out = portfolio.return_stats(_portfolio(spark, sf), "day")
    return out.select("portfolio", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"), F.round("sharpe", 6).alias("sharpe"), F.round("annual_std", 6).alias("annual_std"))


@query(
    "portfolio_value",
    f"""WITH {_PORTFOLIO} SELECT portfolio, round(1000 / arg_min(price, day) * (arg_max(price, day) + sum(paid) - arg_max(paid, day)), 6) AS value FROM y GROUP BY portfolio""",
)
def portfolio_value(spark, sf):
    return portfolio.final_value(_portfolio(spark, sf), "day").withColumn("value", F.round("value", 6))


@query(
    "sharpe",
    f"""WITH {BARS}, r AS (SELECT symbol, (lead(close) OVER w - close + dividends) / close AS ret FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts))
    SELECT symbol, round(avg(ret), 8) AS mean, round(stddev_pop(ret), 8) AS std, round(sqrt(252) * avg(ret) / stddev_pop(ret), 6) AS sharpe FROM r GROUP BY symbol""",
)
def sharpe(spark, sf):
    returns = win.next_return(bars(spark, sf), ["symbol"], "ts", "close", "dividends")
    out = portfolio.series_stats(returns, ["symbol"], "ret")
    return out.select("symbol", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"), F.round("sharpe", 6).alias("sharpe"))
