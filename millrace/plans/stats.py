"""Quantiles, correlation, histograms, divergence, returns and bootstrap."""

from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import statistics as st
from millrace.plans.registry import query
from millrace.plans.tables import table


@query(
    "exact_quantiles",
    """SELECT event_type, round(quantile_cont(value, 0.05), 6) AS q05, round(quantile_cont(value, 0.5), 6) AS q50,
    round(quantile_cont(value, 0.95), 6) AS q95 FROM events GROUP BY event_type""",
)
def exact_quantiles(spark, sf):
    out = st.exact_quantiles(table(spark, sf, "events"), "value", [0.05, 0.5, 0.95], ["event_type"])
    return out.select(
        "event_type", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q05", "q50", "q95"))]
    )


@query(
    "approx_quantiles",
    """SELECT quantile_disc(l_quantity, 0.05) AS quantity_low, quantile_disc(l_quantity, 0.95) AS quantity_high,
    quantile_disc(l_extendedprice, 0.3) AS price_p30 FROM lineitem""",
)
def approx_quantiles(spark, sf):
    df = table(spark, sf, "lineitem")
    out = st.approx_quantiles(df, ["l_quantity", "l_extendedprice"], [0.05, 0.3, 0.95], 1_000_000)
    return out.select(
        F.col("l_quantity")[0].alias("quantity_low"),
        F.col("l_quantity")[2].alias("quantity_high"),
        F.col("l_extendedprice")[1].alias("price_p30"),
    )


_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "corr_with_target",
    "WITH t AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS late FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{m}' AS metric, round(corr({m}, late), 8) AS corr FROM t" for m in _METRICS),
)
def corr_with_target(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("late", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return st.correlations_with(df, "late", _METRICS).withColumn("corr", F.round("corr", 8))


_CORR_SRC = "(SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + l_tax AS doubled FROM lineitem)"
_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "doubled"]


def _matrix(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("doubled", F.col("l_quantity") * 2 + F.col("l_tax"))
    return st.correlation_matrix(df, _CORR_COLS)


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM {_CORR_SRC}"
        for a in _CORR_COLS
        for b in _CORR_COLS
    ),
)
def corr_matrix(spark, sf):
    return _matrix(spark, sf).select("a", "b", F.round("corr", 8).alias("corr"))


@query(
    "strong_corr_pairs",
    "WITH m AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM {_CORR_SRC}"
        for i, a in enumerate(_CORR_COLS)
        for b in _CORR_COLS[i + 1 :]
    )
    + ") SELECT * FROM m WHERE abs(corr) > 0.8 ORDER BY abs(corr) DESC",
)
def strong_corr_pairs(spark, sf):
    return st.strong_pairs(_matrix(spark, sf)).withColumn("corr", F.round("corr", 8))


def _rank_sql(col: str, src: str) -> str:
    """Mean rank of ties."""
    return f"rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0"


_SP = ["l_quantity", "l_discount", "l_tax"]


@query(
    "spearman_matrix",
    "WITH r AS (SELECT "
    + ", ".join(f"{_rank_sql(c, 'lineitem')} AS {c}" for c in _SP)
    + " FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM r" for a in _SP for b in _SP
    ),
)
def spearman_matrix(spark, sf):
    out = st.spearman_matrix(table(spark, sf, "lineitem"), _SP)
    return out.select("a", "b", F.round("corr", 8).alias("corr"))


_CATS = ["o_orderstatus", "o_orderpriority"]


@query(
    "category_spearman",
    "WITH "
    + ", ".join(
        f"""f_{c} AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i_{c}
        FROM orders GROUP BY {c})"""
        for c in _CATS
    )
    + ", t AS (SELECT "
    + ", ".join(f"i_{c}" for c in _CATS)
    + " FROM orders "
    + " ".join(f"JOIN f_{c} USING ({c})" for c in _CATS)
    + "), r AS (SELECT "
    + ", ".join(f"{_rank_sql('i_' + c, 't')} AS {c}" for c in _CATS)
    + " FROM t) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM r" for a in _CATS for b in _CATS
    ),
)
def category_spearman(spark, sf):
    out = st.category_spearman(table(spark, sf, "orders"), _CATS)
    return out.select("a", "b", F.round("corr", 8).alias("corr"))


@query(
    "equal_frequency_bins",
    """WITH e AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7,
      0.8, 0.9, 1.0]))) AS e FROM lineitem),
    b AS (SELECT greatest(len(list_filter(e, lambda x: x < l_extendedprice)), 1) AS bin, e,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS late FROM lineitem, e)
    SELECT CAST(bin AS INTEGER) AS bin, round(min(e[bin]), 4) AS lo, round(max(e[bin + 1]), 4) AS hi, count(*) AS n,
    round(avg(late), 8) AS mean FROM b GROUP BY bin""",
)
def equal_frequency_bins(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("late", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    out = st.equal_frequency_bins(df, "l_extendedprice", 10, "late")
    return out.select("bin", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), "n", F.round("mean", 8).alias("mean"))


@query(
    "equal_width_bins",
    """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    b AS (SELECT least(greatest(ceil((o_totalprice - lo) / ((hi - lo) / 20.0)), 1), 20) AS bin,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS late, lo, (hi - lo) / 20.0 AS w FROM orders, e)
    SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(late), 8) AS mean,
    round(max(lo + (bin - 0.5) * w), 4) AS centre FROM b GROUP BY bin""",
)
def equal_width_bins(spark, sf):
    df = table(spark, sf, "orders").withColumn("late", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    out = st.equal_width_bins(df, "o_totalprice", 20, "late")
    return out.select("bin", "n", F.round("mean", 8).alias("mean"), F.round("centre", 4).alias("centre"))


@query(
    "kl_divergence",
    """WITH s AS (SELECT event_type, value AS v FROM events WHERE event_type IN ('click', 'view')),
    e AS (SELECT min(v) AS lo, max(v) AS hi FROM s),
    h AS (SELECT least(CAST(floor((v - lo) / (hi - lo) * 100) AS INTEGER), 99) AS bin,
      count(*) FILTER (WHERE event_type = 'click') AS np, count(*) FILTER (WHERE event_type = 'view') AS nq
      FROM s, e GROUP BY 1),
    a AS (SELECT i AS bin, coalesce(np, 0) AS np, coalesce(nq, 0) AS nq FROM range(100) r(i) LEFT JOIN h ON i = bin),
    d AS (SELECT np / (SELECT sum(np) FROM a) / ((hi - lo) / 100.0) + 1e-10 AS dp,
      nq / (SELECT sum(nq) FROM a) / ((hi - lo) / 100.0) + 1e-10 AS dq FROM a, e),
    z AS (SELECT dp / (SELECT sum(dp) FROM d) AS p, dq / (SELECT sum(dq) FROM d) AS q FROM d)
    SELECT round(sum(p * ln(p / q)), 8) AS kl_pq, round(sum(q * ln(q / p)), 8) AS kl_qp FROM z""",
)
def kl_divergence(spark, sf):
    out = st.kl_divergence(table(spark, sf, "events"), "value", "event_type", "click", "view")
    return out.select(F.round("kl_pq", 8).alias("kl_pq"), F.round("kl_qp", 8).alias("kl_qp"))


@query(
    "discrete_kl",
    """WITH g AS (SELECT o_orderpriority AS k, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS np,
      sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS nq FROM orders GROUP BY 1),
    d AS (SELECT np / sum(np) OVER () AS p, nq / sum(nq) OVER () AS q FROM g)
    SELECT round(sum(p * ln(p / q)), 10) AS kl_pq, round(sum(q * ln(q / p)), 10) AS kl_qp FROM d""",
)
def discrete_kl(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("np"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("nq"),
    )
    out = st.discrete_kl(df, "o_orderpriority", "np", "nq")
    return out.select(F.round("kl_pq", 10).alias("kl_pq"), F.round("kl_qp", 10).alias("kl_qp"))


def _returns(spark, sf):
    return table(spark, sf, "events").select("event_type", "event_id", ((F.col("value") - 50) / 1000).alias("ret"))


_RETURNS = "t AS (SELECT event_type, (value - 50) / 1000 AS ret FROM events)"


@query(
    "geo_mean",
    f"""WITH {_RETURNS}, g AS (SELECT event_type, avg(ret) AS a, exp(avg(ln(1 + ret))) - 1 AS g, count(*) AS n
      FROM t GROUP BY 1)
    SELECT event_type, round(a, 8) AS arithmetic, round(g, 8) AS geometric, n, round((a - g) / g, 6) AS gap FROM g""",
)
def geo_mean(spark, sf):
    out = st.mean_returns(_returns(spark, sf), ["event_type"], "ret")
    return out.select(
        "event_type", F.round("arithmetic", 8).alias("arithmetic"), F.round("geometric", 8).alias("geometric"), "n",
        F.round("gap", 6).alias("gap"),
    )


_DAILY = """d AS (SELECT event_type, CAST(ts AS DATE) AS day, avg((value - 50) / 1000) AS ret FROM events GROUP BY 1, 2)"""


def _daily_returns(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.avg((F.col("value") - 50) / 1000).alias("ret"))
    )


@query(
    "growth",
    f"""WITH {_DAILY}, g AS (SELECT event_type, 1000 * exp(sum(ln(1 + ret))) AS f, 1000 * pow(1.002, count(*)) AS p
      FROM d GROUP BY 1)
    SELECT event_type, round(f, 4) AS final, round(p, 4) AS projected, round(f - p, 4) AS gap FROM g""",
)
def growth(spark, sf):
    out = st.compounded(_daily_returns(spark, sf), ["event_type"], "ret", 1000.0, 0.002)
    return out.select("event_type", *[F.round(c, 4).alias(c) for c in ("final", "projected", "gap")])


@query(
    "fixed_stake_gain",
    f"WITH {_DAILY} SELECT event_type, round(sum(1000 * ret), 4) AS gain FROM d GROUP BY 1",
)
def fixed_stake_gain(spark, sf):
    out = st.fixed_stake_gain(_daily_returns(spark, sf), ["event_type"], "ret", 1000.0)
    return out.withColumn("gain", F.round("gain", 4))


def _mixed_sql(inner: str, columns: str, name: str) -> str:
    """``inner`` with its column ``name`` mixed as the operator does."""
    out = inner
    for _ in range(2):
        out = f"SELECT {columns}, (xor({name}, {name} >> 16) * {0x45D9F3B}) & {0xFFFFFFFF} AS {name} FROM ({out})"
    return f"SELECT {columns}, xor({name}, {name} >> 16) AS {name} FROM ({out})"


def _draws_sql(rows: str, draws: str, seed: int) -> str:
    """Replicates ``draws`` (rep, v) of the numbered ``rows`` (rn, v), as the operator draws them in a single block."""
    start = _mixed_sql("SELECT range AS rep, range + 1 AS x FROM range(9999)", "rep", "x")
    first = _mixed_sql(f"SELECT 0 AS o, CAST({seed * 1_000_003 & 0xFFFFFFFF} AS BIGINT) AS x", "o", "x")
    start = _mixed_sql(f"SELECT rep, xor(s.x, f.x) AS x FROM ({start}) s, ({first}) f", "rep", "x")
    places = _mixed_sql(f"SELECT n, unnest(range(n)) AS x FROM (SELECT count(*) AS n FROM {rows})", "n", "x")
    both = _mixed_sql(f"SELECT rep, n, xor(s.x, p.x) AS x FROM ({start}) s, ({places}) p", "rep, n", "x")
    return f"""{draws} AS (SELECT rep, v FROM (SELECT rep, ((x * n) >> 32) + 1 AS rn FROM ({both})) JOIN {rows} USING (rn))"""


@query(
    "bootstrap_interval",
    f"""WITH {_DAILY}, o AS (SELECT row_number() OVER (ORDER BY event_type, day) AS rn, ret AS v FROM d WHERE ret IS NOT NULL), {_draws_sql("o", "b", 7)},
    t AS (SELECT avg(v) AS mean, stddev_pop(v) AS std FROM b GROUP BY rep),
    q AS (SELECT quantile_cont(mean, 0.025) AS ml, quantile_cont(mean, 0.975) AS mh, quantile_cont(std, 0.025) AS sl, quantile_cont(std, 0.975) AS sh FROM t)
    SELECT round(ml, 8) AS mean_low, round(mh, 8) AS mean_high, round(sl, 8) AS std_low, round(sh, 8) AS std_high,
    round(sqrt(252) * ml / sh, 6) AS sharpe_low, round(sqrt(252) * mh / sl, 6) AS sharpe_high FROM q""",
)
def bootstrap_interval(spark, sf):
    daily = _daily_returns(spark, sf)
    out = st.sharpe_bounds(st.bootstrap_interval(daily, "ret", ["event_type", "day"], seed=7))
    return out.select(*[F.round(c, 6 if c.startswith("sharpe") else 8).alias(c) for c in out.columns])


@query(
    "bootstrap_std_gap",
    f"""WITH e AS (SELECT CAST(ts AS DATE) AS day, avg(CASE WHEN event_type = 'click' THEN value END) AS click, avg(CASE WHEN event_type = 'view' THEN value END) AS view
      FROM events GROUP BY 1),
    c AS (SELECT row_number() OVER (ORDER BY day) AS rn, click AS v FROM e WHERE click IS NOT NULL), w AS (SELECT row_number() OVER (ORDER BY day) AS rn, view AS v FROM e WHERE view IS NOT NULL),
    {_draws_sql("c", "x", 7)}, {_draws_sql("w", "y", 8)},
    g AS (SELECT a.s - b.s AS gap FROM (SELECT rep, stddev_pop(v) AS s FROM x GROUP BY rep) a JOIN (SELECT rep, stddev_pop(v) AS s FROM y GROUP BY rep) b USING (rep))
    SELECT round(quantile_cont(gap, 0.025), 8) AS gap_low, round(quantile_cont(gap, 0.975), 8) AS gap_high FROM g""",
)
def bootstrap_std_gap(spark, sf):
    wide = (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(
            F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("click"),
            F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("view"),
        )
    )
    out = st.bootstrap_std_gap(wide, "click", "view", ["day"], seed=7)
    return out.select(*[F.round(c, 8).alias(c) for c in out.columns])


@query(
    "two_level_mean",
    """WITH y AS (SELECT year(o_orderdate) AS y, 100.0 * avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS pct
      FROM orders GROUP BY 1) SELECT round(avg(pct), 6) AS mean_pct FROM y""",
)
def two_level_mean(spark, sf):
    df = table(spark, sf, "orders").withColumn("late", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    rates = agg.rate_trend(df, "o_orderdate", [], "late", 12)
    return agg.mean_rate(rates).withColumn("mean_pct", F.round("mean_pct", 6))
