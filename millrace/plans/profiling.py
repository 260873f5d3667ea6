"""Profiles, coercion, recoding, splits and imputation."""

from pyspark.sql import functions as F

from millrace.functions import conditions, times
from millrace.operators import clean, profile
from millrace.operators.roles import Roles
from millrace.plans.registry import query
from millrace.plans.tables import LEG_ORDER, LEG_ORDER_SQL, LEGS, legs, table

_LEG_COLS = ["leg_id", "origin", "dest", "late", "tail", "wind", "temp", "sky"]


@query(
    "null_percentages",
    f"WITH {LEGS} SELECT "
    + ", ".join(
        f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL" + (f" OR {c} = ''" if c == "sky" else "") + f") / count(*), 4) AS {c}"
        for c in _LEG_COLS
    )
    + " FROM legs",
)
def null_percentages(spark, sf):
    return profile.null_percentages(legs(spark, sf).select(*_LEG_COLS), 4)


@query(
    "keep_dense_columns",
    f"WITH {LEGS} SELECT origin, dest, temp, count(*) AS n FROM legs GROUP BY ALL",
)
def keep_dense_columns(spark, sf):
    kept = profile.keep_columns(legs(spark, sf).select("origin", "dest", "tail", "temp", "wind", "sky", "late"), 12.0, ["late"])
    return kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("n"))


@query("table_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def table_shape(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


@query("distinct_values", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_values(spark, sf):
    return profile.distinct_sorted(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()


_SUMMARY = ["l_quantity", "l_extendedprice", "l_tax"]


@query(
    "summary_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in _SUMMARY
    ),
)
def summary_stats(spark, sf):
    out = profile.summary(table(spark, sf, "lineitem"), _SUMMARY)
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query(
    "typed_coercion",
    """WITH t AS (SELECT event_id, CAST(event_id AS VARCHAR) AS id_text, props AS bad_number,
      CAST(value AS VARCHAR) AS v, strftime(ts, '%Y-%m-%d') AS day FROM events)
    SELECT event_id, TRY_CAST(id_text AS INTEGER) AS id_text, TRY_CAST(bad_number AS INTEGER) AS bad_number,
    round(CAST(v AS DOUBLE), 6) AS v, CAST(TRY_CAST(day AS DATE) AS VARCHAR) AS day FROM t""",
)
def typed_coercion(spark, sf):
    text = table(spark, sf, "events").select(
        "event_id",
        F.col("event_id").cast("string").alias("id_text"),
        F.col("props").alias("bad_number"),
        F.col("value").cast("string").alias("v"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    spec = {"int": ["id_text", "bad_number", "not_there"], "double": ["v"], "date": ["day"]}
    typed = clean.coerce_schema(text, spec)
    return typed.withColumns({"v": F.round("v", 6), "day": F.col("day").cast("string")})


@query(
    "coerce_to_text_and_union",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, 'customer' AS era FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, 'supplier' FROM supplier""",
)
def coerce_to_text_and_union(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    b = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    a = clean.as_text(a, ["key"]).withColumn("era", F.lit("customer"))
    return a.unionByName(clean.as_text(b, ["key"]).withColumn("era", F.lit("supplier")))


@query(
    "rename_drop_select",
    "SELECT n_nationkey AS id, n_name AS title FROM nation",
)
def rename_drop_select(spark, sf):
    out = clean.rename(table(spark, sf, "nation"), {"n_nationkey": "id", "n_name": "title"})
    return clean.keep_listed(clean.drop_listed(out, ["n_regionkey", "unknown"]), ["id", "title", "unknown"])


@query("select_except", "SELECT * EXCLUDE (l_tax, l_shipdate) FROM lineitem")
def select_except(spark, sf):
    return spark.sql(
        "SELECT * EXCEPT (l_tax, l_shipdate) FROM {li}", li=table(spark, sf, "lineitem")
    )


@query(
    "select_expressions",
    "SELECT o_orderkey AS id, round(o_totalprice * 1.1, 4) AS gross, upper(o_orderpriority) AS priority FROM orders",
)
def select_expressions(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "round(o_totalprice * 1.1D, 4) AS gross", "upper(o_orderpriority) AS priority"
    )


@query(
    "lateral_alias",
    """WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice, lag(o_totalprice) OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate, o_orderkey) AS prev FROM orders)
    SELECT o_orderkey, prev, round(o_totalprice - prev, 4) AS step, round((o_totalprice - prev) * 2, 4) AS twice FROM a""",
)
def lateral_alias(spark, sf):
    return spark.sql(
        """SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev,
        round(o_totalprice - prev, 4) AS step, round((o_totalprice - prev) * 2, 4) AS twice FROM {orders}""",
        orders=table(spark, sf, "orders"),
    )


@query(
    "temp_view_sql",
    "SELECT r_name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name",
)
def temp_view_sql(spark, sf):
    for name in ("region", "nation"):
        table(spark, sf, name).createOrReplaceTempView(f"mr_{name}")
    return spark.sql(
        "SELECT r_name, count(*) AS n FROM mr_region JOIN mr_nation ON n_regionkey = r_regionkey GROUP BY r_name"
    )


@query(
    "zero_fill",
    f"WITH {LEGS} SELECT leg_id, line, coalesce(wind, 0) AS wind, round(coalesce(temp, 0), 6) AS temp FROM legs",
)
def zero_fill(spark, sf):
    out = clean.zero_fill(legs(spark, sf).select("leg_id", "line", "wind", "temp"), ["wind", "temp"])
    return out.withColumn("temp", F.round("temp", 6))


@query(
    "outcome_recode",
    f"""WITH {LEGS} SELECT leg_id, line, CASE WHEN late IS NULL AND cancelled = 1 THEN 2 ELSE late END AS marked,
    CASE WHEN late IS NULL AND cancelled = 1 THEN 1 ELSE late END AS folded FROM legs""",
)
def outcome_recode(spark, sf):
    df = legs(spark, sf)
    both = df.withColumns({"marked": F.col("late"), "folded": F.col("late")})
    both = clean.recode_outcome(both, "marked", "cancelled")
    return clean.recode_outcome(both, "folded", "cancelled", fold=True).select("leg_id", "line", "marked", "folded")


@query("equality_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")
def equality_filter(spark, sf):
    return table(spark, sf, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")
    ).select("o_orderkey")


@query("range_filter", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def range_filter(spark, sf):
    return table(spark, sf, "orders").filter(F.year("o_orderdate").between(1996, 1998)).select("o_orderkey")


@query("set_filter", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def set_filter(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query(
    "require_critical",
    f"WITH {LEGS} SELECT leg_id, line, wind, tail FROM legs WHERE wind IS NOT NULL AND tail IS NOT NULL",
)
def require_critical(spark, sf):
    return clean.require(legs(spark, sf), ["wind", "tail"]).select("leg_id", "line", "wind", "tail")


@query(
    "require_unless_cancelled",
    f"""WITH {LEGS} SELECT leg_id, line, wind, cancelled FROM legs
    WHERE (wind IS NOT NULL AND tail IS NOT NULL) OR cancelled = 1""",
)
def require_unless_cancelled(spark, sf):
    out = clean.require(legs(spark, sf), ["wind", "tail"], unless=F.col("cancelled") == 1)
    return out.select("leg_id", "line", "wind", "cancelled")


@query(
    "negative_to_null",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer",
)
def negative_to_null(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", conditions.negative_to_null(F.col("c_acctbal")).alias("balance"))


@query(
    "split_by_year",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) <= 2000
    THEN 'validation' ELSE 'test' END AS split FROM orders""",
)
def split_by_year(spark, sf):
    return clean.split_by_year(table(spark, sf, "orders"), "o_orderdate", 1998, 2000).select("o_orderkey", "split")


@query(
    "split_by_season",
    """SELECT o_orderkey, CASE WHEN quarter(o_orderdate) = 4 THEN 'test' WHEN month(o_orderdate) IN (8, 9)
    THEN 'validation' ELSE 'train' END AS split FROM orders""",
)
def split_by_season(spark, sf):
    return clean.split_by_season(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "split")


@query(
    "calendar_fill",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1900 ELSE CAST(year(o_orderdate) AS INTEGER) END AS y,
    CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m,
    CAST(day(o_orderdate) AS INTEGER) AS d, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS w FROM orders""",
)
def calendar_fill(spark, sf):
    none = F.lit(None).cast("int")
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 2 == 0, 1900).alias("y"),
        none.alias("q"), none.alias("m"), none.alias("d"), none.alias("w"),
    )
    names = {"y": "year", "q": "quarter", "m": "month", "d": "day", "w": "weekday"}
    return clean.fill_calendar(df, "o_orderdate", names).drop("o_orderdate")


@query(
    "default_nulls",
    f"""WITH {LEGS} SELECT leg_id, line, coalesce(late, 0) AS late, coalesce(tail, 0) AS tail, coalesce(wind, 0) AS wind,
    round(coalesce(temp, 0), 6) AS temp, coalesce(sky, 'UNKNOWN') AS sky FROM legs""",
)
def default_nulls(spark, sf):
    df = legs(spark, sf).select("leg_id", "line", "late", "tail", "wind", F.round("temp", 6).alias("temp"), "sky")
    return clean.default_nulls(df)


_IMPUTE = f"""WITH {LEGS}, s AS (SELECT * FROM legs WHERE dest < 10),
    w AS (SELECT *, avg(wind) OVER (PARTITION BY origin, day ORDER BY {LEG_ORDER_SQL} ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS d,
      avg(wind) OVER (PARTITION BY origin ORDER BY {LEG_ORDER_SQL} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS p FROM legs),
    m AS (SELECT origin AS o, month(day) AS mo, quantile_disc(wind, 0.5) AS med FROM legs GROUP BY 1, 2),
    f AS (SELECT w.*, coalesce(wind, d, p, med) AS filled FROM w JOIN m ON w.origin = m.o AND month(w.day) = m.mo)
    SELECT leg_id, line, distance, round(coalesce(filled, (SELECT quantile_disc(filled, 0.5) FROM f), 0), 6) AS wind FROM f"""


@query("impute_cascade", _IMPUTE.replace("s AS (SELECT * FROM legs WHERE dest < 10),\n", ""))
def impute_cascade(spark, sf):
    out = clean.impute_readings(legs(spark, sf), ["wind"], Roles(), LEG_ORDER)
    return out.select("leg_id", "line", "distance", F.round("wind", 6).alias("wind"))


@query(
    "impute_category",
    f"""WITH {LEGS}, w AS (SELECT *, first_value(sky IGNORE NULLS) OVER (PARTITION BY origin, day ORDER BY {LEG_ORDER_SQL}
      ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS d FROM legs),
    m AS (SELECT origin AS o, month(day) AS mo, arg_min(sky, (day, hhmm, leg_id, line, distance)) FILTER (WHERE sky IS NOT NULL)
      AS first FROM legs GROUP BY 1, 2),
    f AS (SELECT w.*, coalesce(sky, d, first) AS filled FROM w JOIN m ON origin = o AND month(day) = mo),
    g AS (SELECT filled FROM f WHERE filled IS NOT NULL GROUP BY filled ORDER BY count(*) DESC, filled LIMIT 1)
    SELECT leg_id, line, distance, coalesce(filled, (SELECT filled FROM g), 'CLR') AS sky FROM f""",
)
def impute_category(spark, sf):
    out = clean.impute_category(legs(spark, sf), "sky", Roles(), ["day", "hhmm", "leg_id", "line", "distance"])
    return out.select("leg_id", "line", "distance", "sky")


@query(
    "impute_centred_mean",
    f"""WITH {LEGS}, w AS (SELECT *, avg(wind) OVER (PARTITION BY origin ORDER BY {LEG_ORDER_SQL}
      ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS a FROM legs)
    SELECT leg_id, line, distance, round(coalesce(wind, a), 6) AS wind FROM w""",
)
def impute_centred_mean(spark, sf):
    out = clean.impute_centred(legs(spark, sf), ["wind"], ["origin"], LEG_ORDER)
    return out.select("leg_id", "line", "distance", F.round("wind", 6).alias("wind"))


@query(
    "fill_from_group_median",
    f"""WITH {LEGS}, m AS (SELECT origin AS o, dest AS t, quantile_disc(wind, 0.5) AS med FROM legs GROUP BY 1, 2)
    SELECT leg_id, line, distance, coalesce(wind, med) AS wind FROM legs JOIN m ON origin = o AND dest = t""",
)
def fill_from_group_median(spark, sf):
    out = clean.fill_from_group_median(legs(spark, sf), ["origin", "dest"], ["wind"])
    return out.select("leg_id", "line", "distance", "wind")


@query("full_cleaning_pass")
def full_cleaning_pass(spark, sf):
    calendar = {"year": "year", "quarter": "quarter", "month": "month", "monthday": "day", "weekday": "weekday"}
    lands = (times.hhmm_minutes(F.col("hhmm")) + F.col("minutes").cast("int")) % 1440
    df = legs(spark, sf).withColumns({c: F.lit(None).cast("int") for c in calendar}).withColumns(
        {
            "arr_hhmm": (F.floor(lands / F.lit(60)) * 100 + lands % 60).cast("int"),
            "elapsed": F.when(F.col("leg_id") % 4 != 0, F.col("minutes").cast("int")),
            "arr_block": F.lit(None).cast("string"),
            "remark": F.when(F.col("leg_id") % 9 != 0, F.col("carrier")),
            "station": F.col("origin") % 100,
            "equipped": F.when(F.col("leg_id") % 7 > 1, F.date_format(F.trunc("day", "year"), "yyyy-MM-dd")),
        }
    )
    return clean.clean_pass(
        df, Roles(), LEG_ORDER, ["day", "carrier", "origin", "dest", "hhmm"], ["wind", "temp"], "sky",
        calendar=calendar, text=["remark"], arrival="arr_hhmm", elapsed="elapsed", station="station", equipment=["equipped"],
    )


@query("early_cleaning_pass")
def early_cleaning_pass(spark, sf):
    return clean.simple_clean_pass(
        legs(spark, sf), Roles(), LEG_ORDER, ["day", "carrier", "origin", "tail"], ["wind"], ["temp"], "sky", "distance"
    )
