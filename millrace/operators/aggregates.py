"""Grouped rates, shares, bins and classification scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import maths, strings
from millrace.operators.keyed import attach, top_per_group
from millrace.operators.quantiles import discrete_quantiles


def rate_by(df: DataFrame, keys: Sequence[str], flag: str, digits: int = 2) -> DataFrame:
    """Rows, flagged rows and their percentage per group."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(flag).cast("long").alias("hits"))
        .withColumn("pct", maths.percent(F.col("hits"), F.col("n"), digits))
    )


def ranked(df: DataFrame, by: str, n: int, worst: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` rows by a column, ties broken by ``ties``; no full sort."""
    first = F.desc(by) if worst else F.asc(by)
    return df.orderBy(first, *ties).limit(n)


def rate_trend(df: DataFrame, date: str, keys: Sequence[str], flag: str, digits: int = 2) -> DataFrame:
    """``rate_by`` per year of ``date``."""
    return rate_by(df.withColumn("year", F.year(date)), ["year", *keys], flag, digits)


def mean_rate(rates: DataFrame, keys: Sequence[str] = (), col: str = "pct") -> DataFrame:
    """Second-level mean of already aggregated percentages."""
    return rates.groupBy(*keys).agg(F.avg(col).alias("mean_pct"))


def rate_and_volume(df: DataFrame, keys: dict[str, Column], flag: str) -> DataFrame:
    """Mean percentage and row count per derived key (month, hour, weekday …)."""
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.avg(F.col(flag) * 100).alias("pct"), F.count(F.lit(1)).alias("n")
    )


def rate_matrix(df: DataFrame, row: str, col: str, flag: str, values: Sequence, prefix: str = "c") -> DataFrame:
    """Mean percentage as a ``row`` × ``col`` matrix; listing the values saves a pass."""
    wide = df.groupBy(row).pivot(col, list(values)).agg(F.avg(F.col(flag) * 100))
    return wide.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def worst_within(
    df: DataFrame, outer: str, inner: str, flag: str, groups: int, per_group: int, min_rows: int
) -> DataFrame:
    """The ``groups`` largest outer groups and in each the worst inner groups.

    Inner groups need more than ``min_rows`` rows. One job for all outer groups.
    """
    big = df.groupBy(outer).agg(F.count(F.lit(1)).alias("outer_n"))
    big = big.orderBy(F.desc("outer_n"), outer).limit(groups)  # at most ``groups`` rows
    rates = rate_by(df, [outer, inner], flag, 6).filter(F.col("n") > min_rows)
    joined = rates.join(F.broadcast(big), outer)
    return top_per_group(joined, [outer], [F.desc("pct"), F.asc(inner)], per_group)


def part_shares(df: DataFrame, keys: Sequence[str], parts: Sequence[str], nulls: str = "null") -> DataFrame:
    """Percentage of each part in the total of all parts.

    A row with a null part has a null total and drops out of the lower sum only;
    ``nulls="zero"`` counts missing parts as 0 instead.
    """
    cols = {p: F.coalesce(F.col(p), F.lit(0.0)) if nulls == "zero" else F.col(p) for p in parts}
    total = None
    for c in cols.values():
        total = c if total is None else total + c
    return df.groupBy(*keys).agg(
        *[(maths.share(F.sum(c), F.sum(total)) * 100).alias(f"{p}_pct") for p, c in cols.items()],
        F.count(F.lit(1)).alias("n"),
    )


def range_summary(df: DataFrame, key: str, value: str, flag: str, unit: str) -> DataFrame:
    """Rate, volume, smallest and largest value of each group and a range label."""
    return (
        df.groupBy(key)
        .agg(
            F.avg(F.col(flag) * 100).alias("pct"),
            F.count(flag).alias("n"),
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
        )
        .withColumn("range", strings.range_label(F.col("lo"), F.col("hi"), unit))
    )


def value_shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per value and their percentage of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return attach(counts, [], {"total": F.sum("n")}).withColumn(
        "pct", F.lit(100.0) * F.col("n") / F.col("total")
    ).drop("total")


def conditional_stats(df: DataFrame, keys: Sequence[str], cond: Column, value: str) -> DataFrame:
    """Count, share and mean over only the rows that meet ``cond``."""
    return df.groupBy(*keys).agg(
        F.count_if(cond).alias("n_match"),
        (F.count_if(cond) / F.count(F.lit(1))).alias("share"),
        F.avg(F.when(cond, F.col(value))).alias("mean_match"),
    )


def medians(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Medians of many columns, the lower one of an even number; exact for groups of any size."""
    return discrete_quantiles(df, {f"{c}_median": (c, 0.5) for c in cols}, keys)


def modes(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Most frequent non-null value per group; the smaller value wins a tie."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min_by(col, F.struct(-F.col("__n"), F.col(col)))
    return counts.groupBy(*keys).agg(best.alias(f"{col}_mode"))


def first_values(df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str]) -> DataFrame:
    """First non-null value per group in the given order."""
    order_key = F.when(F.col(col).isNotNull(), F.struct(*order))
    return df.groupBy(*keys).agg(F.min_by(col, order_key).alias(f"{col}_first"))


def confusion_scores(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """Confusion counts, precision, recall, F1 and F2 per group in one pass; 0 where undefined.

    ``rows`` names a column that tells how many rows a row stands for.
    """
    met = lambda y, p: (F.col(label) == y) & (F.col(prediction) == p)
    hit = lambda y, p: F.coalesce(F.sum(F.when(met(y, p), F.col(rows))), F.lit(0)) if rows else F.count_if(met(y, p))
    counts = df.groupBy(*keys).agg(
        hit(1, 1).alias("tp"), hit(0, 0).alias("tn"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn")
    )
    zero_safe = lambda a, b: F.coalesce(maths.share(a, b), F.lit(0.0))
    p, r = F.col("precision"), F.col("recall")
    return (
        counts.withColumn("precision", zero_safe(F.col("tp"), F.col("tp") + F.col("fp")))
        .withColumn("recall", zero_safe(F.col("tp"), F.col("tp") + F.col("fn")))
        .withColumn("f1", zero_safe(2 * p * r, p + r))
        .withColumn("f2", zero_safe(5 * p * r, 4 * p + r))
    )


def compare_scores(sets: dict[str, DataFrame], label: str, prediction: str) -> DataFrame:
    """Scores of several prediction sets, one row each, from one job."""
    stacked = None
    for name, df in sets.items():
        one = df.select(F.lit(name).alias("dataset"), F.col(label), F.col(prediction))
        stacked = one if stacked is None else stacked.unionByName(one)
    return confusion_scores(stacked, label, prediction, ["dataset"])


def class_weights(df: DataFrame, label: str, rate: float | None = None, name: str = "weight") -> DataFrame:
    """Add ``n / (2 n_class)``; ``rate`` assumes a share of positives instead of counting them."""
    wide = attach(df, [], {"__n": F.count(F.lit(1)), "__pos": F.count_if(F.col(label) == 1)})
    n = F.col("__n").cast("double")
    pos = F.col("__pos").cast("double") if rate is None else F.floor(n * F.lit(rate)).cast("double")
    weight = F.when(F.col(label) == 1, n / F.nullif(2 * pos, F.lit(0.0))).otherwise(
        n / F.nullif(2 * (n - pos), F.lit(0.0))
    )
    return wide.withColumn(name, weight).drop("__n", "__pos")


def flag_weights(df: DataFrame, flags: Sequence[str], target: str, fallback: float = 0.15) -> DataFrame:
    """One row with a weight per flag: its rate lift, floored at 0 and scaled to sum 1.

    Equal weights when no flag lifts the rate. One job for all flags.
    """
    t = F.col(target)
    # A missing or zero rate counts as the fallback rate.
    rate = lambda f, v: F.coalesce(
        F.nullif(F.avg(F.when(F.col(f) == v, t)), F.lit(0.0)), F.lit(fallback)
    )
    lifts = df.agg(*[F.greatest(rate(f, 1) - rate(f, 0), F.lit(0.0)).alias(f) for f in flags])
    total = None
    for f in flags:
        total = F.col(f) if total is None else total + F.col(f)
    equal = F.lit(1.0 / len(flags))
    return lifts.select(*[F.when(total > 0, F.col(f) / total).otherwise(equal).alias(f) for f in flags])


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """``sum(value * weight) / sum(weight)`` per group."""
    return df.groupBy(*keys).agg(
        maths.share(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("weighted_mean")
    )


def mean_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
