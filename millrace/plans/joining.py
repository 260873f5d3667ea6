"""Nearest, interval, as-of, lookup and membership joins."""

from pyspark.sql import functions as F

from millrace.functions import maths, times
from millrace.operators import joins, keyed
from millrace.operators import windows as win
from millrace.operators.quantiles import discrete_quantiles
from millrace.plans.registry import query
from millrace.plans.tables import BARS, LEG_ORDER, LEG_ORDER_SQL, LEGS, bars, legs, table
from millrace.sources.dims import STATE_ZONES, state_zones

_PLACES = """a AS (SELECT c_custkey AS place, (c_custkey * 7 % 1201) / 10 - 60 AS lat, (c_custkey * 13 % 3401) / 10 - 170 AS lon FROM customer),
    s AS (SELECT s_suppkey AS station, (s_suppkey * 11 % 1103) / 10 - 55 AS slat, (s_suppkey * 17 % 3307) / 10 - 165 AS slon FROM supplier)"""


def _places(spark, sf):
    a = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("place"),
        ((F.col("c_custkey") * 7 % 1201) / 10 - 60).alias("lat"),
        ((F.col("c_custkey") * 13 % 3401) / 10 - 170).alias("lon"),
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("station"),
        ((F.col("s_suppkey") * 11 % 1103) / 10 - 55).alias("slat"),
        ((F.col("s_suppkey") * 17 % 3307) / 10 - 165).alias("slon"),
    )
    return a, s


def _nearest_sql(k: int) -> str:
    return f"""WITH {_PLACES}, d AS (SELECT place, station, {maths.RADIUS_KM} * 2 * asin(sqrt(least(
      pow(sin(radians(slat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(slat)) * pow(sin(radians(slon - lon) / 2), 2), 1)))
      AS distance_km FROM a, s),
    r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY distance_km, station) AS rank FROM d)
    SELECT place, station, round(distance_km, 4) AS distance_km, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {k}"""


@query("nearest_station", _nearest_sql(1))
def nearest_station(spark, sf):
    a, s = _places(spark, sf)
    out = joins.nearest(a, s, ("place", "lat", "lon"), ("station", "slat", "slon"))
    return out.withColumn("distance_km", F.round("distance_km", 4))


@query("nearest_three_stations", _nearest_sql(3))
def nearest_three_stations(spark, sf):
    a, s = _places(spark, sf)
    out = joins.nearest(a, s, ("place", "lat", "lon"), ("station", "slat", "slon"), k=3)
    return out.withColumn("distance_km", F.round("distance_km", 4))


@query(
    "dimension_join",
    "WITH z(state, zone) AS (VALUES "
    + ", ".join(f"('{s}', '{z}')" for s, z in STATE_ZONES)
    + """), c AS (SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' ELSE 'XX' END AS state FROM customer)
    SELECT c_custkey, c.state, zone FROM c LEFT JOIN z ON c.state = z.state""",
)
def dimension_join(spark, sf):
    state = F.element_at(F.array(*[F.lit(s) for s in ("CA", "NY", "TX", "XX")]), F.col("c_nationkey") % 4 + 1)
    df = table(spark, sf, "customer").select("c_custkey", state.alias("state"))
    return joins.dimension_join(df, state_zones(spark), ["state"])


_LOCAL = "day + INTERVAL 1 MINUTE * CAST(hhmm // 100 * 60 + hhmm % 100 AS INTEGER)"


@query(
    "state_local_to_utc",
    # A local time that the clocks repeat is the earlier one; the SQL engine takes the later.
    f"WITH {LEGS}, z(state, zone) AS (VALUES "
    + ", ".join(f"('{s}', '{z}')" for s, z in STATE_ZONES)
    + f"""), l AS (SELECT leg_id, line, distance, {_LOCAL} AS local, CASE origin % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'HI'
      WHEN 3 THEN 'AZ' ELSE 'XX' END AS state FROM legs),
    u AS (SELECT leg_id, line, distance, l.state, least(timezone(zone, local), timezone(zone, local - INTERVAL 1 HOUR) + INTERVAL 1 HOUR) AS utc
      FROM l LEFT JOIN z ON l.state = z.state)
    SELECT leg_id, line, distance, state, CAST(epoch(utc) AS BIGINT) AS utc FROM u""",
)
def state_local_to_utc(spark, sf):
    state = F.element_at(F.array(*[F.lit(s) for s in ("CA", "NY", "HI", "AZ", "XX")]), (F.col("origin") % 5 + 1).cast("int"))
    df = legs(spark, sf).select("leg_id", "line", "distance", state.alias("state"), times.at_clock(F.col("day"), F.col("hhmm")).alias("local"))
    out = joins.dimension_join(df, state_zones(spark), ["state"])
    return out.select("leg_id", "line", "distance", "state", F.unix_timestamp(times.to_utc(F.col("local"), F.col("zone"))).alias("utc"))


# Places share a station when their keys agree modulo 10; an event is due 8 hours after it was logged.
_EVENT_SQL = """e AS (SELECT event_id, user_id AS place, ts + INTERVAL 8 HOUR AS due FROM events WHERE event_type = 'purchase'),
    w AS (SELECT event_id AS reading_id, user_id AS place, ts AS taken, value FROM events WHERE event_type <> 'purchase')"""


def _event_sides(spark, sf):
    ev = table(spark, sf, "events")
    e = ev.filter(F.col("event_type") == "purchase").select(
        "event_id", F.col("user_id").alias("place"), times.shift_hours(F.col("ts"), 8).alias("due")
    )
    w = ev.filter(F.col("event_type") != "purchase").select(
        F.col("event_id").alias("reading_id"), F.col("user_id").alias("place"), F.col("ts").alias("taken"), "value"
    )
    return e, w


def _interval_sql(how: str, extra: str = "", hi: int = 2, lo: int = 4) -> str:
    return f"""WITH {_EVENT_SQL} SELECT e.event_id, e.place, w.reading_id, w.value FROM e {how} JOIN w ON e.place = w.place
      AND w.taken BETWEEN e.due - INTERVAL {lo} HOUR AND e.due - INTERVAL {hi} HOUR {extra}"""


_SAME_HOUR = "AND date_trunc('hour', w.taken) = date_trunc('hour', e.due - INTERVAL 4 HOUR)"


def _interval(spark, sf, **kw):
    e, w = _event_sides(spark, sf)
    return joins.interval_join(e, w, ["place"], "due", "taken", **kw).select("event_id", "place", "reading_id", "value")


@query("interval_join_start", _interval_sql("LEFT", _SAME_HOUR))
def interval_join_start(spark, sf):
    return _interval(spark, sf, bucket="start")


@query("interval_join_cover", _interval_sql("LEFT"))
def interval_join_cover(spark, sf):
    return _interval(spark, sf, bucket="cover")


@query("interval_join_inner", _interval_sql("", lo=24))
def interval_join_inner(spark, sf):
    return _interval(spark, sf, lo_hours=-24, how="inner")


@query(
    "interval_join_latest",
    f"""WITH {_EVENT_SQL} SELECT e.event_id, e.place, arg_max(w.reading_id, (w.taken, w.reading_id)) AS reading_id,
    arg_max(w.value, (w.taken, w.reading_id)) AS value FROM e LEFT JOIN w ON e.place = w.place
    AND w.taken BETWEEN e.due - INTERVAL 24 HOUR AND e.due - INTERVAL 2 HOUR GROUP BY e.event_id, e.place""",
)
def interval_join_latest(spark, sf):
    return _interval(spark, sf, lo_hours=-24, pick="latest", event_id=["event_id"])


@query(
    "two_key_left_join",
    """WITH y AS (SELECT c_nationkey AS nation, year(o_orderdate) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' GROUP BY 1, 2)
    SELECT o_orderkey, nation, CAST(year AS INTEGER) AS year, mean_price FROM
    (SELECT o_orderkey, c_nationkey AS nation, year(o_orderdate) AS year FROM orders JOIN customer ON o_custkey = c_custkey)
    LEFT JOIN y USING (nation, year)""",
)
def two_key_left_join(spark, sf):
    nations = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    df = table(spark, sf, "orders").join(nations, "o_custkey").withColumn("year", F.year("o_orderdate"))
    means = df.filter(F.col("o_orderstatus") == "P").groupBy("nation", "year").agg(
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("mean_price")
    )
    rows = df.select("o_orderkey", "nation", "year")
    return keyed.join_on(rows, means, ["nation", "year"], "left", null_safe=False)


@query(
    "full_outer_counts",
    """WITH a AS (SELECT c_nationkey AS nation, count(*) AS customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
    b AS (SELECT s_nationkey AS nation, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
    SELECT CAST(coalesce(a.nation, b.nation) AS INTEGER) AS nation, coalesce(customers, 0) AS customers,
    coalesce(suppliers, 0) AS suppliers FROM a FULL JOIN b ON a.nation = b.nation""",
)
def full_outer_counts(spark, sf):
    a = table(spark, sf, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nation"))
    b = table(spark, sf, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation"))
    a, b = a.agg(F.count(F.lit(1)).alias("customers")), b.agg(F.count(F.lit(1)).alias("suppliers"))
    return joins.full_counts(a, b, ["nation"], ["customers", "suppliers"])


@query(
    "attach_group_stats",
    f"""WITH {LEGS}, g AS (SELECT origin AS o, avg(late) AS rate, count(*) AS volume FROM legs GROUP BY 1)
    SELECT leg_id, line, distance, round(rate, 8) AS rate, volume FROM legs JOIN g ON origin = o""",
)
def attach_group_stats(spark, sf):
    out = keyed.attach(legs(spark, sf), ["origin"], {"rate": F.avg("late"), "volume": F.count(F.lit(1))})
    return out.select("leg_id", "line", "distance", F.round("rate", 8).alias("rate"), "volume")


@query(
    "price_dividend_join",
    f"""WITH {BARS}, d AS (SELECT symbol, ts, dividends FROM bars WHERE dividends > 0)
    SELECT b.symbol, CAST(epoch(b.ts) AS BIGINT) AS ts, round(b.close, 4) AS close, coalesce(d.dividends, 0) AS dividends
    FROM bars b LEFT JOIN d ON b.symbol = d.symbol AND b.ts = d.ts""",
)
def price_dividend_join(spark, sf):
    b = bars(spark, sf)
    paid = b.filter("dividends > 0").select("symbol", "ts", "dividends")
    out = joins.dimension_join(b.select("symbol", "ts", "close"), paid, ["symbol", "ts"]).na.fill(0.0, ["dividends"])
    return out.select("symbol", F.unix_timestamp("ts").alias("ts"), F.round("close", 4).alias("close"), "dividends")


@query(
    "overlapping_texts",
    """SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
    AND text IN (SELECT text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))""",
)
def overlapping_texts(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    labelled, other = joins.shared_rows(docs, labels, ["doc_id"]), joins.unseen(docs, labels, ["doc_id"])
    return joins.shared_rows(labelled, other, ["text"]).select("doc_id")


@query(
    "shared_key_values",
    "SELECT doc_id, quality, toxic FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')",
)
def shared_key_values(spark, sf):
    docs = table(spark, sf, "documents").filter("lang = 'en'").select("doc_id", "lang")
    return joins.shared_rows(table(spark, sf, "labels"), docs)


@query("resume_unseen", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_unseen(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.unseen(docs, table(spark, sf, "labels"), ["doc_id"])


@query(
    "flag_hubs",
    f"""WITH {LEGS}, v AS (SELECT origin, count(*) AS n FROM legs WHERE carrier = 'F' GROUP BY 1),
    h AS (SELECT origin FROM v WHERE n >= (SELECT quantile_disc(n, 0.85) FROM v))
    SELECT leg_id, line, distance, CASE WHEN origin IN (SELECT origin FROM h) THEN 1 ELSE 0 END AS is_hub FROM legs""",
)
def flag_hubs(spark, sf):
    df = legs(spark, sf)
    volume = df.filter("carrier = 'F'").groupBy("origin").agg(F.count(F.lit(1)).alias("n"))
    cut = discrete_quantiles(volume, {"cut": ("n", 0.85)}).scalar()
    hubs = volume.filter(F.col("n") >= cut)
    return joins.flag_members(df, hubs, "origin", "is_hub").select("leg_id", "line", "distance", "is_hub")


@query(
    "pair_prompt_and_answer",
    """SELECT u.conv_id, u.turn, length(u.text) AS prompt_chars, length(a.text) AS answer_chars
    FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'""",
)
def pair_prompt_and_answer(spark, sf):
    c = table(spark, sf, "conversations")
    prompts = c.filter("role = 'user'").select("conv_id", "turn", F.length("text").cast("long").alias("prompt_chars"))
    answers = c.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.length("text").cast("long").alias("answer_chars")
    )
    return joins.pair_rows(prompts, answers, ["conv_id", "turn"])


_ASOF = """WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    r AS (SELECT event_id AS rid, user_id, ts AS rts, value FROM events WHERE event_type = 'click')
    SELECT l.event_id, l.user_id, {arg}(r.rid, (rts, rid)) FILTER (WHERE r.rid IS NOT NULL) AS matched_rid,
    {arg}(r.value, (rts, rid)) FILTER (WHERE r.rid IS NOT NULL) AS matched_value
    FROM l LEFT JOIN r ON l.user_id = r.user_id AND rts {op} l.ts GROUP BY 1, 2"""


def _asof(spark, sf, direction):
    ev = table(spark, sf, "events")
    left = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = ev.filter("event_type = 'click'").select(F.col("event_id").alias("rid"), "user_id", F.col("ts").alias("rts"), "value")
    out = joins.asof(left, right, ["user_id"], "ts", "rts", ["rid", "value"], direction)
    return out.select("event_id", "user_id", "matched_rid", "matched_value")


@query("asof_backward", _ASOF.format(arg="arg_max", op="<="))
def asof_backward(spark, sf):
    return _asof(spark, sf, "backward")


@query("asof_forward", _ASOF.format(arg="arg_min", op=">="))
def asof_forward(spark, sf):
    return _asof(spark, sf, "forward")


@query(
    "lowest_price_of_day",
    f"""WITH {BARS}, d AS (SELECT symbol, CAST(ts AS DATE) AS day, min(close) AS low FROM bars GROUP BY 1, 2)
    SELECT b.symbol, CAST(epoch(b.ts) AS BIGINT) AS ts, round(d.low, 4) AS day_low FROM bars b
    JOIN d ON b.symbol = d.symbol AND CAST(b.ts AS DATE) = d.day""",
)
def lowest_price_of_day(spark, sf):
    b = bars(spark, sf)
    out = joins.day_low(b, b, "symbol", "ts", "close")
    return out.select("symbol", F.unix_timestamp("ts").alias("ts"), F.round("day_low", 4).alias("day_low"))


_PREV_SQL = f"""p AS (SELECT *, lag(cancelled) OVER w AS prev_cancelled, lag(origin) OVER w AS prev_origin,
      lag(day + INTERVAL 1 MINUTE * CAST(hhmm // 100 * 60 + hhmm % 100 + minutes AS INTEGER)) OVER w AS prev_arrival,
      day + INTERVAL 1 MINUTE * CAST(hhmm // 100 * 60 + hhmm % 100 AS INTEGER) AS departs
      FROM legs WINDOW w AS (PARTITION BY tail ORDER BY {LEG_ORDER_SQL}, origin))"""


def _with_previous(spark, sf):
    df = legs(spark, sf).withColumn("departs", times.at_clock(F.col("day"), F.col("hhmm")))
    df = df.withColumn("arrives", times.shift_minutes(F.col("departs"), F.col("minutes")))
    prev = {"prev_cancelled": "cancelled", "prev_origin": "origin", "prev_arrival": "arrives"}
    return win.previous_event(df, "tail", [*LEG_ORDER, "origin"], prev)


@query(
    "prev_event_lag",
    f"""WITH {LEGS}, {_PREV_SQL} SELECT leg_id, line, distance, CASE WHEN tail IS NOT NULL THEN prev_cancelled END AS prev_cancelled,
    CASE WHEN tail IS NOT NULL THEN prev_origin END AS prev_origin FROM p""",
)
def prev_event_lag(spark, sf):
    return _with_previous(spark, sf).select("leg_id", "line", "distance", "prev_cancelled", "prev_origin")


@query(
    "path_triplet",
    f"""WITH {LEGS}, {_PREV_SQL} SELECT leg_id, line, distance,
    CASE WHEN tail IS NOT NULL THEN date_diff('minute', prev_arrival, departs) END AS minutes_between,
    CASE WHEN tail IS NOT NULL THEN concat_ws('->', prev_origin, origin, dest) END AS path FROM p""",
)
def path_triplet(spark, sf):
    out = win.with_gap_and_path(_with_previous(spark, sf), "tail", "origin", "dest", "prev_origin", "prev_arrival", "departs")
    return out.select("leg_id", "line", "distance", "minutes_between", "path")


@query(
    "prefer_first_source",
    """SELECT c_nationkey AS nation, CAST(max(c_custkey) AS BIGINT) AS who, 'customer' AS side FROM customer WHERE c_acctbal > 9500
    GROUP BY 1 UNION ALL SELECT s_nationkey, max(s_suppkey), 'supplier' FROM supplier
    WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9500) GROUP BY 1""",
)
def prefer_first_source(spark, sf):
    c = table(spark, sf, "customer").filter("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("nation"))
    s = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation"))
    sides = [
        c.agg(F.max("c_custkey").alias("who"), F.lit("customer").alias("side")),
        s.agg(F.max("s_suppkey").alias("who"), F.lit("supplier").alias("side")),
    ]
    return win.prefer_first_source(sides, "nation")


@query(
    "dedupe_on_keys",
    """SELECT l_orderkey, l_linenumber, arg_min(l_partkey, (l_shipdate, l_partkey, l_suppkey)) AS l_partkey
    FROM lineitem GROUP BY 1, 2""",
)
def dedupe_on_keys(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    out = keyed.deduplicate(df, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


# Every departure is moved into the month the readings cover.
@query(
    "flagship_departures_with_readings",
    f"""WITH {LEGS}, {_PREV_SQL}, e AS (SELECT *, DATE '2024-01-02' + INTERVAL 1 MINUTE *
      CAST(date_diff('day', DATE '1995-01-01', day) % 28 * 1440 + hhmm // 100 * 60 + hhmm % 100 AS INTEGER) AS due FROM p),
    r AS (SELECT user_id % 100 AS station, ts AS taken, event_id AS reading_id, value FROM events)
    SELECT e.leg_id, e.line, e.distance, r.reading_id, r.value, CASE WHEN tail IS NOT NULL THEN e.prev_origin END AS prev_origin
    FROM e LEFT JOIN r ON e.origin % 100 = r.station AND r.taken BETWEEN e.due - INTERVAL 4 HOUR AND e.due - INTERVAL 2 HOUR""",
)
def flagship_departures_with_readings(spark, sf):
    start = F.to_date(F.lit("2024-01-02"))
    shift = F.datediff("day", F.lit("1995-01-01")) % 28
    e = _with_previous(spark, sf).withColumns(
        {"due": times.at_clock(F.date_add(start, shift), F.col("hhmm")), "station": F.col("origin") % 100}
    )
    r = table(spark, sf, "events").select(
        (F.col("user_id") % 100).alias("station"), F.col("ts").alias("taken"), F.col("event_id").alias("reading_id"), "value"
    )
    out = joins.interval_join(e, r, ["station"], "due", "taken")
    return out.select("leg_id", "line", "distance", "reading_id", "value", "prev_origin")
