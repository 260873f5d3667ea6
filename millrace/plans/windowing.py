"""Lagged, trailing, expanding and ranked features."""

from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators import features, keyed, ordered
from millrace.operators import windows as win
from millrace.operators.quantiles import attach_quantiles, discrete_quantiles
from millrace.operators.roles import Roles
from millrace.plans.registry import query
from millrace.plans.tables import BARS, LEG_ORDER, LEG_ORDER_SQL, LEGS, bars, legs, table

_ID = ["leg_id", "line", "distance"]


def _out(df, *cols, digits=8):
    """Identifying columns and rounded doubles."""
    kinds = dict(df.dtypes)
    return df.select(*_ID, *[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in cols])


def _win(keys: str, frame: str = "") -> str:
    return f"(PARTITION BY {keys} ORDER BY {LEG_ORDER_SQL} {frame})"


_BACK = "ROWS BETWEEN {} PRECEDING AND CURRENT ROW"
_BEFORE = "ROWS BETWEEN {} PRECEDING AND 1 PRECEDING"


@query("partition_count", f"WITH {LEGS} SELECT leg_id, line, distance, count(*) OVER (PARTITION BY origin, day) AS ops FROM legs")
def partition_count(spark, sf):
    return _out(keyed.attach(legs(spark, sf), ["origin", "day"], {"ops": F.count(F.lit(1))}), "ops")


@query(
    "row_number_top",
    f"""WITH {LEGS}, r AS (SELECT origin, dest, leg_id, distance, row_number() OVER (PARTITION BY origin ORDER BY distance DESC, leg_id, dest)
      AS rank FROM legs) SELECT origin, dest, leg_id, distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""",
)
def row_number_top(spark, sf):
    df = legs(spark, sf).select("origin", "dest", "leg_id", "distance")
    return keyed.top_per_group(df, ["origin"], [F.desc("distance"), F.asc("leg_id"), F.asc("dest")], 3)


@query(
    "trailing_sum_rows",
    f"""WITH {LEGS} SELECT leg_id, line, distance, sum(minutes) OVER {_win("origin", _BACK.format(29))} AS volume FROM legs""",
)
def trailing_sum_rows(spark, sf):
    out = win.trailing(legs(spark, sf), ["origin"], LEG_ORDER, {"volume": ("sum", F.col("minutes"))}, 29)
    return _out(out, "volume")


@query(
    "trailing_sum_days",
    f"""WITH {LEGS} SELECT leg_id, line, distance, sum(minutes) OVER (PARTITION BY origin ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING
      AND CURRENT ROW) AS volume, round(avg(late) OVER (PARTITION BY origin ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING
      AND CURRENT ROW), 8) AS rate FROM legs""",
)
def trailing_sum_days(spark, sf):
    cols = {"volume": ("sum", F.col("minutes")), "rate": ("avg", F.col("late"))}
    out = win.trailing(legs(spark, sf), ["origin"], LEG_ORDER, cols, 29, frame="days", day="day")
    return _out(out, "volume", "rate")


@query(
    "trailing_rate",
    f"""WITH {LEGS} SELECT leg_id, line, distance, round(coalesce(avg(late) OVER {_win("origin", _BACK.format(365))}, 0.15), 8) AS rate FROM legs""",
)
def trailing_rate(spark, sf):
    out = win.trailing(legs(spark, sf), ["origin"], LEG_ORDER, {"rate": ("avg", F.col("late"))}, 365)
    return _out(out.withColumn("rate", F.coalesce("rate", F.lit(0.15))), "rate")


@query(
    "expanding_count",
    f"""WITH {LEGS} SELECT leg_id, line, distance, count(*) OVER {_win("origin, dest", "ROWS UNBOUNDED PRECEDING")} AS volume FROM legs""",
)
def expanding_count(spark, sf):
    out = win.expanding(legs(spark, sf), ["origin", "dest"], LEG_ORDER, {"volume": ("count", F.lit(1))})
    return _out(out, "volume")


@query(
    "trailing_share",
    f"""WITH {LEGS} SELECT leg_id, line, distance, round(count(CASE WHEN carrier = 'F' THEN 1 END) OVER w / count(*) OVER w, 8) AS share
    FROM legs WINDOW w AS {_win("origin", _BACK.format(365))}""",
)
def trailing_share(spark, sf):
    cols = {"mine": ("count", F.when(F.col("carrier") == "F", 1)), "every": ("count", F.lit(1))}
    out = win.trailing(legs(spark, sf), ["origin"], LEG_ORDER, cols, 365)
    return _out(out.withColumn("share", F.col("mine") / F.col("every")), "share")


@query(
    "conditional_averages",
    f"""WITH {LEGS} SELECT leg_id, line, distance, round(coalesce(avg(CASE WHEN carrier = 'F' THEN late END) OVER a, 0.15), 8) AS recent,
    round(coalesce(avg(CASE WHEN carrier = 'F' THEN late END) OVER b, 0.15), 8) AS ever FROM legs
    WINDOW a AS {_win("origin", _BACK.format(29))}, b AS {_win("origin, dest", "ROWS UNBOUNDED PRECEDING")}""",
)
def conditional_averages(spark, sf):
    df, mine = legs(spark, sf), F.when(F.col("carrier") == "F", F.col("late"))
    out = win.trailing(df, ["origin"], LEG_ORDER, {"recent": ("avg", mine)}, 29, sizes=df)
    out = win.expanding(out, ["origin", "dest"], LEG_ORDER, {"ever": ("avg", mine)}, sizes=df)
    return _out(out.na.fill(0.15, ["recent", "ever"]), "recent", "ever")


@query(
    "partition_average",
    f"WITH {LEGS} SELECT leg_id, line, distance, round(avg(late) OVER (PARTITION BY origin, day), 8) AS rate FROM legs",
)
def partition_average(spark, sf):
    return _out(keyed.attach(legs(spark, sf), ["origin", "day"], {"rate": F.avg("late")}), "rate")


@query(
    "prior_row_rate",
    f"""WITH {LEGS}, d AS (SELECT *, avg(late) OVER (PARTITION BY origin, day) AS r, avg(late) OVER (PARTITION BY origin) AS m FROM legs)
    SELECT leg_id, line, distance, round(coalesce(lag(r) OVER {_win("origin")}, m, 0.15), 8) AS rate FROM d""",
)
def prior_row_rate(spark, sf):
    return _out(win.prior_rate(legs(spark, sf), "origin", "day", LEG_ORDER, "late", "rate"), "rate")


@query(
    "prior_day_rate",
    f"""WITH {LEGS}, d AS (SELECT origin, day, lag(avg(late)) OVER (PARTITION BY origin ORDER BY day) AS r FROM legs GROUP BY 1, 2),
    m AS (SELECT origin, avg(late) AS m FROM legs GROUP BY 1)
    SELECT leg_id, line, distance, round(coalesce(r, m, 0.15), 8) AS rate FROM legs JOIN d USING (origin, day) JOIN m USING (origin)""",
)
def prior_day_rate(spark, sf):
    return _out(win.prior_rate(legs(spark, sf), "origin", "day", LEG_ORDER, "late", "rate", mode="day"), "rate")


@query(
    "same_day_so_far",
    f"""WITH {LEGS}, s AS (SELECT *, count(*) OVER w AS n, coalesce(sum(late) OVER w, 0) AS d FROM legs
      WINDOW w AS {_win("origin, day", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")})
    SELECT leg_id, line, distance, n AS prior_rows_today, CAST(d AS BIGINT) AS prior_late_today, round((d + 0.5) / (n + 1), 8) AS prior_late_share FROM s""",
)
def same_day_so_far(spark, sf):
    out = win.same_day_so_far(legs(spark, sf), "origin", "day", LEG_ORDER, "late")
    return _out(out, "prior_rows_today", "prior_late_today", "prior_late_share")


@query(
    "congestion_history",
    f"""WITH {LEGS}, d AS (SELECT *, count(*) OVER (PARTITION BY origin, day) AS ops, isodow(day) AS dow, hhmm // 100 AS hr FROM legs),
    u AS (SELECT *, coalesce(avg(ops) OVER {_win("origin, dow, hr", _BEFORE.format(365))}, avg(ops) OVER (PARTITION BY origin), 10) AS usual FROM d)
    SELECT leg_id, line, distance, round(usual, 6) AS usual_operations, round(ops / usual, 6) AS congestion FROM u""",
)
def congestion_history(spark, sf):
    out = features.time_profile(legs(spark, sf), Roles(), LEG_ORDER)
    return _out(out, "usual_operations", "congestion", digits=6)


@query(
    "rolling_zscore",
    f"""WITH {LEGS}, s AS (SELECT *, avg(minutes) OVER w AS m, stddev_samp(minutes) OVER w AS sd FROM legs WINDOW w AS {_win("origin", _BACK.format(168))})
    SELECT leg_id, line, distance, round(m, 6) AS minutes_mean, round(sd, 6) AS minutes_std,
    round((minutes - m) / nullif(sd, 0), 6) AS minutes_z FROM s""",
)
def rolling_zscore(spark, sf):
    out = win.rolling_zscore(legs(spark, sf), ["origin"], LEG_ORDER, ["minutes"])
    return _out(out, "minutes_mean", "minutes_std", "minutes_z", digits=6)


@query(
    "seasonal_anomaly",
    f"""WITH {LEGS}, s AS (SELECT *, (minutes - avg(minutes) OVER w) / nullif(stddev_samp(minutes) OVER w, 0) AS z FROM legs
      WINDOW w AS (PARTITION BY origin, month(day)))
    SELECT leg_id, line, distance, round(CASE WHEN z > 0 THEN z ELSE 0 END, 6) AS z FROM s""",
)
def seasonal_anomaly(spark, sf):
    df = legs(spark, sf).withColumn("month", F.month("day"))
    return _out(win.seasonal_zscore(df, ["origin", "month"], "minutes", "z"), "z", digits=6)


@query(
    "expanding_rate_before",
    f"""WITH {LEGS} SELECT leg_id, line, distance, round(coalesce(avg(CASE WHEN carrier = 'F' THEN late END)
      OVER {_win("origin, hhmm // 600", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")}, avg(late) OVER (PARTITION BY origin), 0), 8) AS rate FROM legs""",
)
def expanding_rate_before(spark, sf):
    df = legs(spark, sf).withColumn("part", F.floor(F.col("hhmm") / 600))
    mine = F.when(F.col("carrier") == "F", F.col("late"))
    out = win.expanding(df, ["origin", "part"], LEG_ORDER, {"rate": ("avg", mine)}, include_current=False)
    out = keyed.attach(out, ["origin"], {"place": F.avg("late")}, source=df)
    return _out(out.withColumn("rate", F.coalesce("rate", "place", F.lit(0.0))), "rate")


@query(
    "shrunk_rate",
    f"""WITH {LEGS}, q AS (SELECT quantile_disc(late, 0.3) AS p30 FROM legs)
    SELECT leg_id, line, distance, round((sum(late) OVER w + 3 * p30) / (count(*) OVER w + 3), 8) AS rate FROM legs, q
    WINDOW w AS (PARTITION BY origin, dest, isodow(day))""",
)
def shrunk_rate(spark, sf):
    df = legs(spark, sf).withColumn("dow", times.monday_weekday(F.col("day")))
    p30 = discrete_quantiles(df, {"q": ("late", 0.3)}).scalar()
    return _out(win.shrunk_rate(df, ["origin", "dest", "dow"], "late", p30, 3, "rate"), "rate")


@query(
    "layered_rate",
    f"""WITH {LEGS} SELECT leg_id, line, distance, round(coalesce(avg(late) OVER (PARTITION BY tail, origin, day),
      avg(late) OVER (PARTITION BY origin, dest), 0.5), 8) AS rate FROM legs""",
)
def layered_rate(spark, sf):
    layers = [["tail", "origin", "day"], ["origin", "dest"]]
    return _out(win.layered_rate(legs(spark, sf), layers, "late", F.lit(0.5), "rate"), "rate")


@query(
    "schedule_ratio",
    f"""WITH {LEGS} SELECT leg_id, line, distance, round(coalesce(minutes / avg(minutes) OVER {_win("origin, dest", _BEFORE.format(365))}, 1.0), 8) AS ratio FROM legs""",
)
def schedule_ratio(spark, sf):
    out = win.trailing(
        legs(spark, sf), ["origin", "dest"], LEG_ORDER, {"usual": ("avg", F.col("minutes"))}, 365, include_current=False
    )
    return _out(out.withColumn("ratio", F.coalesce(F.col("minutes") / F.col("usual"), F.lit(1.0))), "ratio")


@query(
    "route_importance",
    f"""WITH {LEGS} SELECT leg_id, line, distance, round(count(*) OVER w / (SELECT count(*) FROM legs)
      + avg(distance) OVER w / (SELECT avg(distance) FROM legs), 6) AS importance FROM legs WINDOW w AS (PARTITION BY origin, dest)""",
)
def route_importance(spark, sf):
    out = win.volume_and_distance_weight(legs(spark, sf), ["origin", "dest"], "distance", "importance")
    return _out(out, "importance", digits=6)


@query(
    "smoothed_rate_ratio",
    f"""WITH {LEGS}, w AS (SELECT *, coalesce(avg(CASE WHEN carrier = 'F' THEN late END) OVER {_win("origin, dest", "ROWS UNBOUNDED PRECEDING")}, 0.15) AS a,
      coalesce(avg(late) OVER {_win("origin", _BACK.format(365))}, 0.15) AS b FROM legs)
    SELECT leg_id, line, distance, round((a + 1e-6) / (b + 1e-6), 4) AS carrier_relative FROM w""",
)
def smoothed_rate_ratio(spark, sf):
    return _out(features.place_profile(legs(spark, sf), Roles(), LEG_ORDER, "F"), "carrier_relative", digits=4)


@query(
    "median_over_partition",
    f"""WITH {LEGS}, m AS (SELECT origin AS o, dest AS t, quantile_disc(minutes, 0.5) AS median FROM legs GROUP BY 1, 2)
    SELECT leg_id, line, distance, median FROM legs JOIN m ON origin = o AND dest = t""",
)
def median_over_partition(spark, sf):
    return _out(attach_quantiles(legs(spark, sf), ["origin", "dest"], {"median": ("minutes", 0.5)}), "median")


@query(
    "global_percent_rank",
    f"WITH {LEGS} SELECT leg_id, line, distance, round(percent_rank() OVER (ORDER BY day, hhmm), 10) AS rank FROM legs",
)
def global_percent_rank(spark, sf):
    return _out(win.percent_rank(legs(spark, sf), ["day", "hhmm"]), "rank", digits=10)


@query(
    "rolling_origin_folds",
    f"""WITH {LEGS}, r AS (SELECT late, percent_rank() OVER (ORDER BY day, hhmm) AS rank FROM legs)
    SELECT cut, CASE WHEN rank <= cut THEN 'train' ELSE 'validation' END AS part, count(*) AS n, CAST(sum(late) AS BIGINT) AS hits
    FROM r, (VALUES (0.2::DOUBLE), (0.4::DOUBLE), (0.6::DOUBLE), (0.8::DOUBLE)) c(cut) GROUP BY 1, 2""",
)
def rolling_origin_folds(spark, sf):
    folds = win.rolling_folds(legs(spark, sf), ["day", "hhmm"])
    return folds.groupBy("cut", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("late").alias("hits"))


@query(
    "lagged_yearly_metric",
    """WITH m AS (SELECT o_custkey AS entity, year(o_orderdate) AS period, count(*) AS volume FROM orders GROUP BY 1, 2)
    SELECT entity, CAST(period AS INTEGER) AS period, volume, coalesce(lag(volume) OVER (PARTITION BY entity ORDER BY period), volume) AS volume_lag FROM m""",
)
def lagged_yearly_metric(spark, sf):
    m = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period"))
    return win.lag_metric(m.agg(F.count(F.lit(1)).alias("volume")), "entity", "period", ["volume"])


def _bar_out(df, *cols, digits=6):
    kinds = dict(df.dtypes)
    return df.select(
        "symbol", F.unix_timestamp("ts").alias("ts"),
        *[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in cols],
    )


_BAR_ID = "symbol, CAST(epoch(ts) AS BIGINT) AS ts"
_BY_TS = "(PARTITION BY symbol ORDER BY ts)"


@query(
    "next_row_return",
    f"WITH {BARS} SELECT {_BAR_ID}, round((lead(close) OVER w - close + dividends) / close, 6) AS ret FROM bars WINDOW w AS {_BY_TS}",
)
def next_row_return(spark, sf):
    return _bar_out(win.next_return(bars(spark, sf), ["symbol"], "ts", "close", "dividends"), "ret")


@query(
    "percentage_change",
    f"WITH {BARS} SELECT {_BAR_ID}, round(close / lag(close) OVER w - 1, 6) AS change FROM bars WINDOW w AS {_BY_TS}",
)
def percentage_change(spark, sf):
    return _bar_out(win.pct_change(bars(spark, sf), ["symbol"], "ts", "close"), "change")


def _minima_sql(test: str) -> str:
    return f"""WITH {BARS}, d AS (SELECT *, sign(lead(close) OVER w - close) AS after, sign(close - lag(close) OVER w) AS b0 FROM bars WINDOW w AS {_BY_TS}),
    e AS (SELECT *, coalesce(b0, after) AS before FROM d) SELECT {_BAR_ID}, CASE WHEN {test} THEN 1 ELSE 0 END AS is_min FROM e"""


@query("local_minima", _minima_sql("after > before"))
def local_minima(spark, sf):
    return _bar_out(win.local_minima(bars(spark, sf), ["symbol"], "ts", "close"), "is_min")


@query("strict_local_minima", _minima_sql("before < 0 AND after > 0"))
def strict_local_minima(spark, sf):
    return _bar_out(win.local_minima(bars(spark, sf), ["symbol"], "ts", "close", strict=True), "is_min")


_CROSS = f"x AS (SELECT *, CASE WHEN lag(open) OVER w <= lag(close) OVER w AND open > close THEN 1 ELSE 0 END AS hit FROM bars WINDOW w AS {_BY_TS})"


@query("crossover", f"WITH {BARS}, {_CROSS} SELECT {_BAR_ID}, hit FROM x")
def crossover(spark, sf):
    return _bar_out(win.crossover(bars(spark, sf), ["symbol"], "ts", "open", "close", "hit"), "hit")


@query(
    "confirmed_cross",
    f"""WITH {BARS}, {_CROSS}, y AS (SELECT *, lag(hit, 2) OVER {_BY_TS} AS then_hit,
      min(CASE WHEN open > close THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS held FROM x)
    SELECT {_BAR_ID}, CASE WHEN then_hit = 1 AND held = 1 THEN 1 ELSE 0 END AS confirmed FROM y""",
)
def confirmed_cross(spark, sf):
    out = win.confirmed_cross(bars(spark, sf), ["symbol"], "ts", "open", "close", "confirmed", bars=2)
    return _bar_out(out, "confirmed")


_EDGE = f"""{_CROSS}, z AS (SELECT *, max(hit) OVER f AS marked, min(CASE WHEN hit = 1 THEN ts END) OVER f AS known FROM x
      WINDOW f AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING))"""


def _marked(spark, sf):
    df = win.crossover(bars(spark, sf), ["symbol"], "ts", "open", "close", "hit")
    return win.within_next(df, ["symbol"], "ts", "hit", "marked")


@query("backfilled_flag", f"WITH {BARS}, {_EDGE} SELECT {_BAR_ID}, marked, CAST(epoch(known) AS BIGINT) AS known_at FROM z")
def backfilled_flag(spark, sf):
    return _bar_out(_marked(spark, sf).withColumn("known_at", F.unix_timestamp("known_at")), "marked", "known_at")


@query(
    "rising_edge",
    f"""WITH {BARS}, {_EDGE} SELECT {_BAR_ID}, CASE WHEN lag(marked) OVER {_BY_TS} = 0 AND marked = 1 THEN 1 ELSE 0 END AS edge FROM z""",
)
def rising_edge(spark, sf):
    return _bar_out(win.rising_edge(_marked(spark, sf), ["symbol"], "ts", "marked", "edge"), "edge")


_LIST = f"w AS (SELECT *, list(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS l FROM bars)"


@query(
    "rolling_argmax",
    f"""WITH {BARS}, {_LIST} SELECT {_BAR_ID}, CASE WHEN len(l) = 5 THEN CAST(list_position(l, list_max(l)) - 1 AS INTEGER) END AS at_max,
    CASE WHEN len(l) = 5 THEN CAST(list_position(l, list_min(l)) - 1 AS INTEGER) END AS at_min FROM w""",
)
def rolling_argmax(spark, sf):
    df = win.rolling_position(bars(spark, sf), ["symbol"], "ts", "close", "at_max")
    return _bar_out(win.rolling_position(df, ["symbol"], "ts", "close", "at_min", of="min"), "at_max", "at_min")


@query(
    "fixed_segments",
    f"WITH {BARS}, {_LIST} SELECT {_BAR_ID}, round(list_sum(l), 4) AS total, len(l) AS n FROM w WHERE len(l) = 5",
)
def fixed_segments(spark, sf):
    out = win.segments(bars(spark, sf), ["symbol"], "ts", "close", 5)
    total = F.aggregate("segment", F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "symbol", F.unix_timestamp("ts").alias("ts"), F.round(total, 4).alias("total"), F.size("segment").alias("n")
    )


@query(
    "run_heads",
    """SELECT event_id, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS is_head
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def run_heads(spark, sf):
    return win.run_heads(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "is_head")


@query(
    "merged_runs",
    """WITH h AS (SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS h FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    r AS (SELECT *, sum(h) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM h)
    SELECT user_id, CAST(run AS BIGINT) AS run, event_type, min(event_id) AS event_id, arg_max(value, event_id) AS value, count(*) AS merged
    FROM r GROUP BY 1, 2, 3""",
)
def merged_runs(spark, sf):
    return win.merge_runs(table(spark, sf, "events"), ["user_id"], "event_id", "event_type", ["event_id"], ["value"])


@query(
    "drawdown",
    f"""WITH {BARS}, p AS (SELECT *, max(close) OVER (PARTITION BY symbol ORDER BY ts) AS peak FROM bars)
    SELECT symbol, round((max(close) - arg_max(close, ts)) / max(close), 6) AS last_drawdown,
    round(max((peak - close) / peak), 6) AS max_drawdown FROM p GROUP BY symbol""",
)
def drawdown(spark, sf):
    out = win.drawdown_summary(bars(spark, sf), ["symbol"], "ts", "close")
    return out.select("symbol", F.round("last_drawdown", 6).alias("last_drawdown"), F.round("max_drawdown", 6).alias("max_drawdown"))


@query(
    "numbered_rows",
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events",
)
def numbered_rows(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return ordered.number_rows(df, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "place_profile",
    f"""WITH {LEGS}, d AS (SELECT *, count(*) OVER (PARTITION BY origin, day) AS ops FROM legs)
    SELECT leg_id, line, distance, ops AS daily_operations, CAST(sum(ops) OVER a AS BIGINT) AS volume_30,
    round(coalesce(avg(late) OVER b, 0.15), 6) AS origin_rate,
    count(*) OVER c AS route_volume, round(count(CASE WHEN carrier = 'F' THEN 1 END) OVER b / count(*) OVER b, 6) AS carrier_share,
    round(coalesce(avg(CASE WHEN carrier = 'F' THEN late END) OVER a, 0.15), 6) AS carrier_rate_30,
    round(coalesce(avg(CASE WHEN carrier = 'F' THEN late END) OVER c, 0.15), 6) AS carrier_route_rate,
    origin || '-' || dest AS route FROM d
    WINDOW a AS {_win("origin", _BACK.format(29))}, b AS {_win("origin", _BACK.format(365))},
      c AS {_win("origin, dest", "ROWS UNBOUNDED PRECEDING")}""",
)
def place_profile(spark, sf):
    out = features.place_profile(legs(spark, sf), Roles(), LEG_ORDER, "F")
    return _out(
        out, "daily_operations", "volume_30", "origin_rate", "route_volume", "carrier_share", "carrier_rate_30",
        "carrier_route_rate", "route", digits=6,
    )


@query(
    "clock_columns",
    f"""WITH {LEGS}, h AS (SELECT *, hhmm // 100 AS hr, isodow(day) AS dow FROM legs)
    SELECT leg_id, line, distance, CAST(hr AS INTEGER) AS dep_hour, hr || '_' || (hhmm % 100) // 15 AS time_bucket,
    CASE WHEN hr BETWEEN 5 AND 9 THEN 'morning' WHEN hr BETWEEN 10 AND 15 THEN 'midday' WHEN hr BETWEEN 16 AND 19 THEN 'evening' ELSE 'night' END AS day_part,
    CASE WHEN dow IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, CASE WHEN month(day) IN (6, 7, 12) THEN 1 ELSE 0 END AS holiday_season FROM h""",
)
def clock_columns(spark, sf):
    return _out(
        features.clock_columns(legs(spark, sf), Roles()), "dep_hour", "time_bucket", "day_part", "is_weekend", "holiday_season"
    )


@query(
    "simple_place_features",
    f"""WITH {LEGS}, g AS (SELECT *, count(*) OVER (PARTITION BY origin, day) AS a, avg(late) OVER (PARTITION BY origin) AS r,
      count(*) OVER (PARTITION BY origin) AS n FROM legs)
    SELECT leg_id, line, distance, a AS origin_day_rows, round(r, 8) AS origin_rate, n / 1000 AS origin_thousands,
    CASE WHEN r < 0.15 THEN 'low_delay' WHEN r < 0.25 THEN 'medium_delay' ELSE 'high_delay' END AS rate_band,
    year(day) || '-Q' || quarter(day) AS year_quarter, (hhmm // 100) || ':' || (hhmm % 100) // 15 * 15 AS clock_bucket,
    isodow(day) || '_' || hhmm // 100 AS day_hour, origin || '-' || dest AS route FROM g""",
)
def simple_place_features(spark, sf):
    out = features.simple_place_features(legs(spark, sf), Roles())
    return _out(
        out, "origin_day_rows", "origin_rate", "origin_thousands", "rate_band", "year_quarter", "clock_bucket", "day_hour", "route"
    )


@query(
    "extreme_flags_score",
    """WITH q AS (SELECT quantile_disc(l_tax, 0.95) AS tax_hi, quantile_disc(l_quantity, 0.95) AS qty_hi, quantile_disc(l_discount, 0.05) AS disc_lo,
      quantile_disc(l_extendedprice, [0.05, 0.95]) AS price FROM lineitem),
    f AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS late,
      CASE WHEN l_tax >= tax_hi THEN 1 ELSE 0 END AS a, CASE WHEN l_quantity >= qty_hi THEN 1 ELSE 0 END AS b,
      CASE WHEN l_discount <= disc_lo THEN 1 ELSE 0 END AS c,
      CASE WHEN l_extendedprice <= price[1] OR l_extendedprice >= price[2] THEN 1 ELSE 0 END AS d FROM lineitem, q),
    w AS (SELECT """
    + ", ".join(
        f"greatest(coalesce(nullif(avg(late) FILTER (WHERE {x} = 1), 0), 0.15) - coalesce(nullif(avg(late) FILTER (WHERE {x} = 0), 0), 0.15), 0) AS w{x}"
        for x in "abcd"
    )
    + """ FROM f), t AS (SELECT *, wa + wb + wc + wd AS total FROM w)
    SELECT l_orderkey, l_linenumber, l_extendedprice, round("""
    + " + ".join(f"{x} * CASE WHEN total > 0 THEN w{x} / total ELSE 0.25 END" for x in "abcd")
    + ", 6) AS score FROM f, t",
)
def extreme_flags_score(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("late", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    flagged = features.extreme_flags(df, ["l_tax", "l_quantity"], ["l_discount"], ["l_extendedprice"])
    flags = ["extreme_l_tax", "extreme_l_quantity", "low_l_discount", "extreme_l_extendedprice"]
    out = features.combined_score(flagged, flags, "late", "score")
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("score", 6).alias("score"))


@query("time_profile")
def time_profile(spark, sf):
    return features.time_profile(legs(spark, sf), Roles(), LEG_ORDER)


@query("reading_profile")
def reading_profile(spark, sf):
    df = legs(spark, sf).withColumns({"humidity": F.col("minutes") * 2, "rain": F.col("distance") / 10000})
    return features.reading_profile(df, Roles(), LEG_ORDER, "temp", "humidity", "wind", "rain", "minutes")


@query(
    "carrier_profile",
    f"""WITH {LEGS}, t AS (SELECT *, isodow(day) AS dow, (hhmm // 100) || '_' || (hhmm % 100 // 15) AS bucket,
      CASE WHEN hhmm // 100 BETWEEN 5 AND 9 THEN 'morning' WHEN hhmm // 100 BETWEEN 10 AND 15 THEN 'midday'
      WHEN hhmm // 100 BETWEEN 16 AND 19 THEN 'evening' ELSE 'night' END AS part FROM legs),
    o AS (SELECT quantile_disc(late, 0.5) AS median, quantile_disc(late, 0.3) AS p30, count(*) AS all_n, avg(distance) AS all_d FROM legs),
    v AS (SELECT origin, count(*) AS n FROM legs WHERE carrier = 'F' GROUP BY 1),
    h AS (SELECT origin FROM v WHERE n >= (SELECT quantile_disc(n, 0.85) FROM v)),
    w AS (SELECT *, coalesce(avg(CASE WHEN carrier = 'F' THEN late END) OVER {_win("origin, part", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")},
        avg(late) OVER (PARTITION BY origin), median) AS part_rate,
      (sum(late) OVER k + 3 * p30) / (count(*) OVER k + 3) AS weekday_rate,
      coalesce(avg(late) OVER (PARTITION BY tail), avg(late) OVER r, median) AS aircraft_rate,
      coalesce(minutes / avg(minutes) OVER {_win("origin, dest", _BEFORE.format(365))}, 1) AS schedule_ratio,
      avg(late) OVER (PARTITION BY origin, bucket) AS b, count(*) OVER r / all_n + avg(distance) OVER r / all_d AS route_importance
      FROM t, o WINDOW k AS (PARTITION BY origin, dest, dow), r AS (PARTITION BY origin, dest))
    SELECT leg_id, line, distance, round(part_rate, 6) AS part_rate, round(weekday_rate, 6) AS weekday_rate, round(aircraft_rate, 6) AS aircraft_rate,
    CASE WHEN origin IN (SELECT origin FROM h) THEN 1 ELSE 0 END AS is_hub, round(schedule_ratio, 6) AS schedule_ratio,
    round(coalesce(b, part_rate), 6) AS bucket_rate, round(route_importance, 6) AS route_importance FROM w""",
)
def carrier_profile(spark, sf):
    df = features.clock_columns(legs(spark, sf), Roles())
    out = features.carrier_profile(df, Roles(), LEG_ORDER, "F")
    return _out(
        out, "part_rate", "weekday_rate", "aircraft_rate", "is_hub", "schedule_ratio", "bucket_rate", "route_importance", digits=6
    )


@query("all_profiles")
def all_profiles(spark, sf):
    return features.all_profiles(legs(spark, sf), Roles(), LEG_ORDER, "F")
