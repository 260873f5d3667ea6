"""Grouped rates, shares, rankings and scores over the departures."""

from pyspark.sql import functions as F

from millrace.functions import conditions, times
from millrace.operators import aggregates as agg
from millrace.plans.registry import query
from millrace.plans.tables import LEGS, legs, table

_RATE = "round(100.0 * sum(late) / count(*), 4)"


@query(
    "worst_return_rates",
    f"""WITH {LEGS} SELECT origin, count(*) AS n, CAST(sum(late) AS BIGINT) AS hits, {_RATE} AS pct
    FROM legs WHERE late IS NOT NULL GROUP BY origin ORDER BY pct DESC, origin LIMIT 10""",
)
def worst_return_rates(spark, sf):
    done = legs(spark, sf).filter(F.col("late").isNotNull())
    return agg.ranked(agg.rate_by(done, ["origin"], "late", 4), "pct", 10, ties=["origin"])


@query(
    "best_return_rates",
    f"""WITH {LEGS} SELECT origin, count(*) AS n, CAST(sum(late) AS BIGINT) AS hits, {_RATE} AS pct
    FROM legs WHERE late IS NOT NULL GROUP BY origin ORDER BY pct, origin LIMIT 10""",
)
def best_return_rates(spark, sf):
    done = legs(spark, sf).filter(F.col("late").isNotNull())
    return agg.ranked(agg.rate_by(done, ["origin"], "late", 4), "pct", 10, worst=False, ties=["origin"])


@query(
    "rate_by_carrier",
    f"""WITH {LEGS} SELECT carrier, count(*) AS n, CAST(sum(late) AS BIGINT) AS hits, {_RATE} AS pct
    FROM legs WHERE late IS NOT NULL GROUP BY carrier""",
)
def rate_by_carrier(spark, sf):
    return agg.rate_by(legs(spark, sf).filter(F.col("late").isNotNull()), ["carrier"], "late", 4)


@query(
    "yearly_rate_trend",
    f"""WITH {LEGS} SELECT CAST(year(day) AS INTEGER) AS year, carrier, count(*) AS n,
    CAST(sum(late) AS BIGINT) AS hits, {_RATE} AS pct
    FROM legs WHERE late IS NOT NULL GROUP BY 1, 2""",
)
def yearly_rate_trend(spark, sf):
    done = legs(spark, sf).filter(F.col("late").isNotNull())
    return agg.rate_trend(done, "day", ["carrier"], "late", 4)


@query(
    "mean_of_yearly_rates",
    f"""WITH {LEGS}, y AS (SELECT year(day) AS y, carrier, 100.0 * sum(late) / count(*) AS pct
    FROM legs WHERE late IS NOT NULL GROUP BY 1, 2)
    SELECT carrier, round(avg(pct), 4) AS mean_pct FROM y GROUP BY carrier""",
)
def mean_of_yearly_rates(spark, sf):
    done = legs(spark, sf).filter(F.col("late").isNotNull())
    rates = agg.rate_trend(done, "day", ["carrier"], "late", 12)
    return agg.mean_rate(rates, ["carrier"]).withColumn("mean_pct", F.round("mean_pct", 4))


@query(
    "monthly_rate",
    f"""WITH {LEGS} SELECT CAST(month(day) AS INTEGER) AS month, round(avg(late * 100), 4) AS pct,
    count(*) AS n FROM legs GROUP BY 1""",
)
def monthly_rate(spark, sf):
    out = agg.rate_and_volume(legs(spark, sf), {"month": F.month("day")}, "late")
    return out.withColumn("pct", F.round("pct", 4))


@query(
    "hourly_rate",
    f"""WITH {LEGS} SELECT CAST(hhmm // 100 AS INTEGER) AS hour, round(avg(late * 100), 4) AS pct,
    count(*) AS n FROM legs GROUP BY 1""",
)
def hourly_rate(spark, sf):
    hour = F.floor(F.col("hhmm") / 100).cast("int")
    out = agg.rate_and_volume(legs(spark, sf), {"hour": hour}, "late")
    return out.withColumn("pct", F.round("pct", 4))


@query(
    "weekday_rate",
    f"""WITH {LEGS} SELECT CAST(isodow(day) AS INTEGER) AS weekday, strftime(day, '%a') AS name,
    round(avg(late * 100), 4) AS pct, count(*) AS n FROM legs GROUP BY 1, 2""",
)
def weekday_rate(spark, sf):
    keys = {"weekday": times.monday_weekday(F.col("day")), "name": times.weekday_name(F.col("day"))}
    return agg.rate_and_volume(legs(spark, sf), keys, "late").withColumn("pct", F.round("pct", 4))


@query(
    "weekday_hour_matrix",
    f"""WITH {LEGS} SELECT CAST(isodow(day) AS INTEGER) AS weekday, """
    + ", ".join(
        f"round(avg(late * 100) FILTER (WHERE hhmm // 100 = {h}), 4) AS h{h}" for h in range(24)
    )
    + " FROM legs GROUP BY 1",
)
def weekday_hour_matrix(spark, sf):
    df = legs(spark, sf).select(
        times.monday_weekday(F.col("day")).alias("weekday"),
        F.floor(F.col("hhmm") / 100).cast("int").alias("hour"),
        "late",
    )
    wide = agg.rate_matrix(df, "weekday", "hour", "late", range(24), "h")
    return wide.select("weekday", *[F.round(f"h{h}", 4).alias(f"h{h}") for h in range(24)])


@query(
    "rate_by_place_and_type",
    f"""WITH {LEGS} SELECT l.origin, CAST(s.s_nationkey AS INTEGER) AS nation, n.n_name AS name,
    round(avg(late * 100), 4) AS pct, count(*) AS n
    FROM legs l JOIN supplier s ON l.origin = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
    GROUP BY 1, 2, 3""",
)
def rate_by_place_and_type(spark, sf):
    places = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("origin"), F.col("s_nationkey").alias("nation"), F.col("n_name").alias("name"))
    )
    rates = agg.rate_and_volume(legs(spark, sf), {"origin": F.col("origin")}, "late")
    return rates.join(places, "origin").select("origin", "nation", "name", F.round("pct", 4).alias("pct"), "n")


@query(
    "worst_routes_of_top_origins",
    f"""WITH {LEGS}, big AS (SELECT origin, count(*) AS outer_n FROM legs GROUP BY origin
      ORDER BY outer_n DESC, origin LIMIT 10),
    r AS (SELECT origin, dest, count(*) AS n, CAST(sum(late) AS BIGINT) AS hits,
      round(100.0 * sum(late) / count(*), 6) AS pct FROM legs GROUP BY 1, 2 HAVING count(*) > 10),
    k AS (SELECT r.*, outer_n, row_number() OVER (PARTITION BY origin ORDER BY pct DESC, dest) AS rank
      FROM r JOIN big USING (origin))
    SELECT origin, dest, n, hits, pct, outer_n, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 5""",
)
def worst_routes_of_top_origins(spark, sf):
    return agg.worst_within(legs(spark, sf), "origin", "dest", "late", 10, 5, 10)


_PARTS = ["l_quantity", "l_tax", "l_discount"]


def _share_sql(zero: bool) -> str:
    part = (lambda p: f"coalesce({p}, 0)") if zero else (lambda p: p)
    total = " + ".join(part(p) for p in _PARTS)
    cols = ", ".join(f"round(100 * sum({part(p)}) / sum({total}), 6) AS {p}_pct" for p in _PARTS)
    return f"""WITH t AS (SELECT CAST(month(l_shipdate) AS INTEGER) AS month,
      CASE WHEN l_orderkey % 4 <> 0 THEN l_quantity END AS l_quantity, l_tax, l_discount
      FROM lineitem WHERE l_returnflag = 'R')
    SELECT month, {cols}, count(*) AS n FROM t GROUP BY month"""


def _share(spark, sf, nulls):
    df = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.month("l_shipdate").alias("month"),
        F.when(F.col("l_orderkey") % 4 != 0, F.col("l_quantity")).alias("l_quantity"),
        "l_tax",
        "l_discount",
    )
    out = agg.part_shares(df, ["month"], _PARTS, nulls)
    return out.withColumns({f"{p}_pct": F.round(f"{p}_pct", 6) for p in _PARTS})


@query("cause_share", _share_sql(False))
def cause_share(spark, sf):
    return _share(spark, sf, "null")


@query("cause_share_zero_filled", _share_sql(True))
def cause_share_zero_filled(spark, sf):
    return _share(spark, sf, "zero")


@query(
    "distance_band_summary",
    """WITH t AS (SELECT p_size, p_retailprice, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS late FROM part),
    g AS (SELECT p_size, round(avg(late * 100), 4) AS pct, count(late) AS n, min(p_retailprice) AS lo,
      max(p_retailprice) AS hi FROM t GROUP BY p_size)
    SELECT *, CASE WHEN lo = hi THEN CAST(floor(lo) AS BIGINT) || ' miles'
      ELSE CAST(floor(lo) AS BIGINT) || '-' || CAST(floor(hi) AS BIGINT) || ' miles' END AS range FROM g""",
)
def distance_band_summary(spark, sf):
    df = table(spark, sf, "part").withColumn("late", F.when(F.col("p_partkey") % 3 == 0, 1).otherwise(0))
    out = agg.range_summary(df, "p_size", "p_retailprice", "late", "miles")
    return out.withColumn("pct", F.round("pct", 4))


@query(
    "status_share",
    f"""WITH {LEGS}, s AS (SELECT CASE WHEN cancelled = 1 THEN 'Cancelled' WHEN late = 1 THEN 'Delayed'
      ELSE 'On-time' END AS status FROM legs),
    c AS (SELECT status, count(*) AS n FROM s GROUP BY status)
    SELECT status, n, round(100.0 * n / sum(n) OVER (), 6) AS pct FROM c""",
)
def status_share(spark, sf):
    df = legs(spark, sf).select(conditions.status_label(F.col("cancelled"), F.col("late")).alias("status"))
    return agg.value_shares(df, ["status"]).withColumn("pct", F.round("pct", 6))


@query(
    "carrier_conditional_stats",
    f"""WITH {LEGS} SELECT origin, count(*) FILTER (WHERE carrier = 'F') AS n_match,
    round(count(*) FILTER (WHERE carrier = 'F') / count(*), 8) AS share,
    round(avg(late) FILTER (WHERE carrier = 'F'), 8) AS mean_match FROM legs GROUP BY origin""",
)
def carrier_conditional_stats(spark, sf):
    out = agg.conditional_stats(legs(spark, sf), ["origin"], F.col("carrier") == "F", "late")
    return out.withColumns({"share": F.round("share", 8), "mean_match": F.round("mean_match", 8)})


@query(
    "group_medians",
    f"""WITH {LEGS} SELECT origin, CAST(month(day) AS INTEGER) AS month, quantile_disc(minutes, 0.5) AS minutes_median,
    quantile_disc(distance, 0.5) AS distance_median FROM legs GROUP BY 1, 2""",
)
def group_medians(spark, sf):
    df = legs(spark, sf).withColumn("month", F.month("day"))
    return agg.medians(df, ["origin", "month"], ["minutes", "distance"])


@query(
    "global_medians",
    f"""WITH {LEGS} SELECT quantile_disc(minutes, 0.5) AS minutes_median,
    quantile_disc(distance, 0.5) AS distance_median FROM legs""",
)
def global_medians(spark, sf):
    return agg.medians(legs(spark, sf), [], ["minutes", "distance"])


_MODE_SQL = f"""WITH {LEGS}, c AS (SELECT {{keys}} sky, count(*) AS n FROM legs WHERE sky IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, row_number() OVER ({{part}} ORDER BY n DESC, sky) AS k FROM c)
    SELECT {{keys}} sky AS sky_mode FROM r WHERE k = 1"""


@query("group_mode", _MODE_SQL.format(keys="origin, dest,", part="PARTITION BY origin, dest"))
def group_mode(spark, sf):
    return agg.modes(legs(spark, sf), ["origin", "dest"], "sky")


@query("global_mode", _MODE_SQL.format(keys="", part=""))
def global_mode(spark, sf):
    return agg.modes(legs(spark, sf), [], "sky")


@query(
    "group_first_value",
    f"""WITH {LEGS} SELECT origin, arg_min(temp, (day, hhmm, leg_id, line, distance)) FILTER (WHERE temp IS NOT NULL)
    AS temp_first FROM legs GROUP BY origin""",
)
def group_first_value(spark, sf):
    return agg.first_values(legs(spark, sf), ["origin"], "temp", ["day", "hhmm", "leg_id", "line", "distance"])


_SCORES = """SELECT {keys} tp, tn, fp, fn, round(p, 8) AS precision, round(r, 8) AS recall,
    round(coalesce(2 * p * r / nullif(p + r, 0), 0), 8) AS f1,
    round(coalesce(5 * p * r / nullif(4 * p + r, 0), 0), 8) AS f2 FROM s"""


def _counts_sql(keys: str, source: str) -> str:
    return f"""c AS (SELECT {keys} count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
      count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
      count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn FROM {source} GROUP BY ALL),
    s AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c)"""


def _rounded_scores(df):
    return df.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1", "f2")})


@query(
    "confusion_metrics",
    f"""WITH t AS (SELECT quality AS y, toxic AS yhat FROM labels), {_counts_sql("", "t")} {_SCORES.format(keys="")}""",
)
def confusion_metrics(spark, sf):
    return _rounded_scores(agg.confusion_scores(table(spark, sf, "labels"), "quality", "toxic"))


@query(
    "metrics_by_dataset",
    f"""WITH t AS (SELECT 'even' AS dataset, quality AS y, toxic AS yhat FROM labels WHERE doc_id % 2 = 0
      UNION ALL SELECT 'odd', quality, toxic FROM labels WHERE doc_id % 2 = 1),
    {_counts_sql("dataset,", "t")} {_SCORES.format(keys="dataset,")}""",
)
def metrics_by_dataset(spark, sf):
    df = table(spark, sf, "labels")
    sets = {"even": df.filter(F.col("doc_id") % 2 == 0), "odd": df.filter(F.col("doc_id") % 2 == 1)}
    return _rounded_scores(agg.compare_scores(sets, "quality", "toxic"))


_WEIGHT_SQL = """WITH n AS (SELECT CAST(count(*) AS DOUBLE) AS n, {pos} AS pos FROM labels)
    SELECT doc_id, quality, round(CASE WHEN quality = 1 THEN n / (2 * pos) ELSE n / (2 * (n - pos)) END, 8) AS weight
    FROM labels, n"""


@query("class_weights", _WEIGHT_SQL.format(pos="CAST(sum(quality) AS DOUBLE)"))
def class_weights(spark, sf):
    out = agg.class_weights(table(spark, sf, "labels"), "quality")
    return out.select("doc_id", "quality", F.round("weight", 8).alias("weight"))


@query("class_weights_assumed_rate", _WEIGHT_SQL.format(pos="floor(count(*) * 0.25)"))
def class_weights_assumed_rate(spark, sf):
    out = agg.class_weights(table(spark, sf, "labels"), "quality", rate=0.25)
    return out.select("doc_id", "quality", F.round("weight", 8).alias("weight"))


@query(
    "condition_weights",
    """WITH t AS (SELECT CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END AS heavy,
      CASE WHEN l_discount <= 0.01 THEN 1 ELSE 0 END AS full_price, CASE WHEN l_tax >= 0.07 THEN 1 ELSE 0 END AS taxed,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS late FROM lineitem),
    r AS (SELECT """
    + ", ".join(
        f"""greatest(coalesce(nullif(avg(late) FILTER (WHERE {f} = 1), 0), 0.15)
        - coalesce(nullif(avg(late) FILTER (WHERE {f} = 0), 0), 0.15), 0) AS {f}"""
        for f in ("heavy", "full_price", "taxed")
    )
    + """ FROM t), s AS (SELECT *, heavy + full_price + taxed AS total FROM r)
    SELECT """
    + ", ".join(
        f"round(CASE WHEN total > 0 THEN {f} / total ELSE 1.0 / 3 END, 6) AS {f}"
        for f in ("heavy", "full_price", "taxed")
    )
    + " FROM s",
)
def condition_weights(spark, sf):
    df = table(spark, sf, "lineitem").select(
        conditions.flag(F.col("l_quantity") >= 45).alias("heavy"),
        conditions.flag(F.col("l_discount") <= 0.01).alias("full_price"),
        conditions.flag(F.col("l_tax") >= 0.07).alias("taxed"),
        conditions.flag(F.col("l_returnflag") == "R").alias("late"),
    )
    flags = ["heavy", "full_price", "taxed"]
    return agg.flag_weights(df, flags, "late").select(*[F.round(f, 6).alias(f) for f in flags])


@query(
    "weighted_mean_metric",
    """SELECT event_type, round(sum(value * (user_id % 7 + 1)) / sum(user_id % 7 + 1), 6) AS weighted_mean
    FROM events GROUP BY event_type""",
)
def weighted_mean_metric(spark, sf):
    df = table(spark, sf, "events").withColumn("size", F.col("user_id") % 7 + 1)
    return agg.weighted_mean(df, ["event_type"], "value", "size").withColumn(
        "weighted_mean", F.round("weighted_mean", 6)
    )


@query(
    "mean_score_by_system",
    """SELECT d.source, round(avg(l.quality), 8) AS mean, count(l.quality) AS n
    FROM documents d JOIN labels l USING (doc_id) GROUP BY d.source""",
)
def mean_score_by_system(spark, sf):
    scored = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id")
    return agg.mean_by(scored, ["source"], "quality").withColumn("mean", F.round("mean", 8))
