"""Quantiles, correlation, histograms, divergence and bootstrap intervals."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import maths
from millrace.operators.keyed import attach, join_on
from millrace.operators.ordered import number_rows, running
from millrace.session import stage


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles as an array ``q`` per group.

    Counts each distinct value, runs totals over the counts and reads off the
    two neighbours of every position, so no group is held in memory whole.
    """
    keys = list(keys)
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    upto = running(counts, keys, [col], {"__upto": ("sum", F.col("__n"))})
    upto = attach(upto, keys, {"__all": F.sum("__n")})
    at = lambda rank: F.min(F.when(F.col("__upto") > rank, F.col(col)))
    picks = []
    for p in probs:
        pos = F.lit(float(p)) * (F.col("__all") - 1)
        frac = F.max(pos - F.floor(pos))
        lo, hi = at(F.floor(pos)), at(F.ceil(pos))
        picks.append(lo + frac * (hi - lo))
    return upto.groupBy(*keys).agg(F.array(*picks).alias("q"))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 20) -> DataFrame:
    """One row of approximate quantile arrays; ``accuracy`` 20 is a rank error of 5 %."""
    return df.agg(*[F.percentile_approx(c, list(probs), accuracy).alias(c) for c in cols])


def correlations_with(df: DataFrame, target: str, metrics: Sequence[str]) -> DataFrame:
    """Pearson correlation of every metric with the target, one row each, one job."""
    wide = df.agg(*[F.corr(m, target).alias(m) for m in metrics])
    return wide.unpivot([], list(metrics), "metric", "corr")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix as rows ``(a, b, corr)``, both triangles and the diagonal.

    All pairs are accumulated in a single pass; only the finished numbers move.
    """
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    wide = df.agg(*[F.corr(cols[i], cols[j]).alias(f"p{i}_{j}") for i, j in pairs])
    both = lambda i, j: f"p{min(i, j)}_{max(i, j)}"
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(i).alias("i"), F.lit(j).alias("j"),
                 F.col(both(i, j)).alias("corr"))
        for i, a in enumerate(cols)
        for j, b in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*cells)))


def strong_pairs(matrix: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Each pair once with an absolute correlation over the threshold, strongest first."""
    return (
        matrix.filter((F.col("i") < F.col("j")) & (F.abs("corr") > threshold))
        .select("a", "b", "corr")
        .orderBy(F.desc(F.abs("corr")), "a", "b")
    )


def frequency_index(df: DataFrame, col: str, name: str) -> DataFrame:
    """Index of a category by falling frequency, ties by value, from 0."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    index = number_rows(counts, [], [F.desc("__n"), F.asc(col)], name)
    index = index.select(col, (F.col(name) - 1).cast("double").alias(name))
    return join_on(df, index, [col], "left")


def average_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace columns by their ranks, tied rows sharing the mean rank.

    Ranks come from running totals over distinct values, not a global sort of rows.
    """
    for c in cols:
        counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
        upto = running(counts, [], [c], {"__upto": ("sum", F.col("__n"))})
        ranks = upto.select(c, (F.col("__upto") - (F.col("__n") - 1) / 2.0).alias("__rank"))
        df = join_on(df, ranks, [c], "left").withColumn(c, F.col("__rank")).drop("__rank")
    return df


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rank correlation of numeric columns."""
    return correlation_matrix(average_ranks(df.select(*cols), cols), cols)


def category_spearman(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rank correlation over frequency-indexed categories."""
    indexed = df.select(*cols)
    for c in cols:
        indexed = frequency_index(indexed, c, f"__i_{c}")
    indexed = indexed.select(*[F.col(f"__i_{c}").alias(c) for c in cols])
    return spearman_matrix(indexed, cols)


def equal_frequency_bins(df: DataFrame, col: str, n: int, value: str) -> DataFrame:
    """Mean of ``value`` in ``n`` bins of equal frequency; equal edges are merged."""
    edges = exact_quantiles(df, col, [i / n for i in range(n + 1)]).select(
        F.array_distinct("q").alias("e")
    ).scalar()
    below = F.size(F.filter(F.col("__e"), lambda e: e < F.col(col)))
    binned = (
        df.filter(F.col(col).isNotNull())
        .withColumn("__e", edges)
        .withColumn("bin", F.greatest(below, F.lit(1)))
    )
    return binned.groupBy("bin").agg(
        F.min(F.element_at("__e", F.col("bin"))).alias("lo"),
        F.max(F.element_at("__e", F.col("bin") + 1)).alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean"),
    )


def equal_width_bins(df: DataFrame, col: str, n: int, value: str) -> DataFrame:
    """Mean of ``value`` in ``n`` bins of equal width, closed on the right, with centres."""
    wide = attach(df.filter(F.col(col).isNotNull()), [], {"__lo": F.min(col), "__hi": F.max(col)})
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(n))
    slot = F.ceil((F.col(col) - F.col("__lo")) / F.nullif(width, F.lit(0.0)))
    slot = F.least(F.greatest(F.coalesce(slot, F.lit(1)), F.lit(1)), F.lit(n)).cast("int")
    return (
        wide.withColumn("bin", slot)
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(value).alias("mean"),
            F.max(F.col("__lo") + (F.col("bin") - 0.5) * width).alias("centre"),
        )
    )


def density_histogram(df: DataFrame, value: str, side: str, bins: int) -> DataFrame:
    """Counts per ``(side, bin)`` over edges both sides share; the last bin is closed."""
    wide = attach(df.select(side, value), [], {"__lo": F.min(value), "__hi": F.max(value)})
    span = F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0.0))
    slot = F.floor((F.col(value) - F.col("__lo")) / span * F.lit(bins)).cast("int")
    slot = F.least(F.coalesce(slot, F.lit(0)), F.lit(bins - 1))
    return wide.groupBy(side, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def kl_divergence(
    df: DataFrame, value: str, side: str, p: str, q: str, bins: int = 100, eps: float = 1e-10
) -> DataFrame:
    """Divergence in nats of the ``p`` rows' histogram from the ``q`` rows', both ways.

    ``eps`` is added to each density before both are scaled to sum 1.
    """
    spark = df.sparkSession
    both = df.filter(F.col(side).isin(p, q)).filter(F.col(value).isNotNull())
    hist = density_histogram(both.withColumn(value, F.col(value).cast("double")), value, side, bins)
    ends = both.agg(((F.max(value) - F.min(value)) / F.lit(float(bins))).alias("w")).scalar()
    total = lambda s: F.sum(F.when(F.col(side) == s, F.col("n")))
    per_bin = hist.groupBy("bin").agg(total(p).alias("np"), total(q).alias("nq"))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    wide = attach(
        spine.join(per_bin, "bin", "left").na.fill(0, ["np", "nq"]).withColumn("w", ends),
        [],
        {"tp": F.sum("np"), "tq": F.sum("nq")},
    )
    dens = wide.select(
        "bin",
        (F.col("np") / F.col("tp") / F.col("w") + F.lit(eps)).alias("dp"),
        (F.col("nq") / F.col("tq") / F.col("w") + F.lit(eps)).alias("dq"),
    )
    scaled = attach(dens, [], {"sp": F.sum("dp"), "sq": F.sum("dq")}).select(
        (F.col("dp") / F.col("sp")).alias("p"), (F.col("dq") / F.col("sq")).alias("q")
    )
    return scaled.agg(
        F.sum(F.col("p") * F.ln(F.col("p") / F.col("q"))).alias("kl_pq"),
        F.sum(F.col("q") * F.ln(F.col("q") / F.col("p"))).alias("kl_qp"),
    )


def discrete_kl(df: DataFrame, key: str, p: str, q: str) -> DataFrame:
    """Divergence of two weight columns over the same keys, both scaled to sum 1."""
    wide = attach(
        df.groupBy(key).agg(F.sum(p).alias("np"), F.sum(q).alias("nq")),
        [],
        {"tp": F.sum("np"), "tq": F.sum("nq")},
    )
    a, b = F.col("np") / F.col("tp"), F.col("nq") / F.col("tq")
    return wide.agg(F.sum(a * F.ln(a / b)).alias("kl_pq"), F.sum(b * F.ln(b / a)).alias("kl_qp"))


def mean_returns(df: DataFrame, keys: Sequence[str], ret: str) -> DataFrame:
    """Arithmetic and geometric mean return and the gap relative to the geometric one."""
    geo = F.exp(F.avg(F.ln(1 + F.col(ret)))) - 1
    return (
        df.groupBy(*keys)
        .agg(F.avg(ret).alias("arithmetic"), geo.alias("geometric"), F.count(ret).alias("n"))
        .withColumn("gap", maths.share(F.col("arithmetic") - F.col("geometric"), F.col("geometric")))
    )


def compounded(df: DataFrame, keys: Sequence[str], ret: str, capital: float, rate: float) -> DataFrame:
    """Capital after compounding every return, next to a constant-rate projection."""
    return (
        df.groupBy(*keys)
        .agg(
            (F.lit(capital) * F.exp(F.sum(F.ln(1 + F.col(ret))))).alias("final"),
            (F.lit(capital) * F.pow(F.lit(1 + rate), F.count(ret))).alias("projected"),
        )
        .withColumn("gap", F.col("final") - F.col("projected"))
    )


def fixed_stake_gain(df: DataFrame, keys: Sequence[str], ret: str, capital: float) -> DataFrame:
    """Sum of gains when the same capital is staked on every return."""
    return df.groupBy(*keys).agg(F.sum(F.lit(capital) * F.col(ret)).alias("gain"))


# Rows of a block of the bootstrap, and replicates that one task draws.
DRAW_BLOCK = 4096
DRAW_REPLICATES = 1250


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers, held as 64-bit ones, that spreads every bit; SQL can repeat it."""
    for _ in range(2):
        x = ((x ^ (x >> 16)) * 0x45D9F3B) & 0xFFFFFFFF
    return x ^ (x >> 16)


def draws_of_block(block: int, n: int, replicates: int, seed: int, size: int = DRAW_BLOCK) -> np.ndarray:
    """How many of its ``n`` draws each replicate makes in one block of ``size`` rows (the last may be shorter).

    The draws of a run of blocks fall to its left half by a binomial number whose seed is the run, so
    every block follows its own path down the halves and all blocks agree without seeing each other.
    """
    first, count, rows = 0, -(-n // size), n
    draws = np.full(replicates, n, dtype=np.int64)
    while count > 1:
        left = (count + 1) // 2
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, first, count])))
        to_left = rng.binomial(draws, left * size / rows)
        if block < first + left:
            draws, count, rows = to_left, left, left * size
        else:
            draws, first, count, rows = draws - to_left, first + left, count - left, rows - left * size
    return draws


def drawn_places(block: int, rep: int, draws: int, rows: int, seed: int) -> np.ndarray:
    """Places, from 0, that one replicate draws in a block of ``rows`` rows."""
    start = _mixed(_mixed(np.int64(seed * 1_000_003 + block & 0xFFFFFFFF)) ^ _mixed(np.int64(rep + 1)))
    return (_mixed(start ^ _mixed(np.arange(draws, dtype=np.int64))) * rows) >> 32


def _replicate_moments(df: DataFrame, value: str, order: Sequence[str], replicates: int, seed: int, size: int = DRAW_BLOCK) -> DataFrame:
    """``rep``, ``mean``, ``std``: each replicate draws as many rows as there are, with replacement.

    Rows are numbered by ``order`` and cut into blocks. A block works out how many draws of each replicate fall to
    it and where, and hands on a count and two sums per replicate: the shuffle has replicates x
    blocks rows, not replicates x rows. Results don't depend on partitioning.
    """
    wanted = df.filter(F.col(value).isNotNull()).select(*order, F.col(value).cast("double").alias("__v"))
    rows = stage(number_rows(wanted, [], list(order), "__rn").select("__rn", "__v"))
    n, centre = rows.agg(F.count("__v"), F.avg("__v")).first()
    if n == 0:
        raise ValueError("bootstrap needs at least one row")

    def draw(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, part = map(int, key)
        x = pdf.sort_values("__rn")["__v"].to_numpy() - centre
        reps = np.arange(part * DRAW_REPLICATES, min(replicates, (part + 1) * DRAW_REPLICATES))
        draws = draws_of_block(block, n, replicates, seed, size)[reps]
        sums = np.empty((len(reps), 2))
        for i, (rep, many) in enumerate(zip(reps.tolist(), draws.tolist(), strict=True)):
            some = x[drawn_places(block, rep, many, len(x), seed)]
            sums[i] = some.sum(), some @ some
        return pd.DataFrame({"rep": reps, "s": sums[:, 0], "q": sums[:, 1]})

    parts = F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // DRAW_REPLICATES))).alias("__part")
    cut = rows.select(F.floor((F.col("__rn") - 1) / F.lit(size)).cast("int").alias("__block"), "__rn", "__v", parts)
    sums = cut.groupBy("__block", "__part").applyInPandas(draw, "rep int, s double, q double")
    total = sums.groupBy("rep").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
    off = F.col("s") / F.lit(float(n))
    spread = F.greatest(F.col("q") / F.lit(float(n)) - off * off, F.lit(0.0))
    return total.select("rep", (F.lit(centre) + off).alias("mean"), F.sqrt(spread).alias("std"))


def _interval(stat: str, level: float) -> list[Column]:
    tail = (1 - level) / 2
    q = F.percentile(stat, F.array(F.lit(tail), F.lit(1 - tail)))
    return [q[0].alias(f"{stat}_low"), q[1].alias(f"{stat}_high")]


def bootstrap_interval(
    df: DataFrame, value: str, order: Sequence[str], replicates: int = 9999, level: float = 0.95, seed: int = 0
) -> DataFrame:
    """Percentile-method intervals of the mean and the population standard deviation."""
    stats = _replicate_moments(df, value, order, replicates, seed)
    return stats.agg(*_interval("mean", level), *_interval("std", level))


def bootstrap_std_gap(
    df: DataFrame, a: str, b: str, order: Sequence[str], replicates: int = 9999, level: float = 0.95, seed: int = 0
) -> DataFrame:
    """Percentile interval of ``std(a) - std(b)``, both columns resampled on their own."""
    one = _replicate_moments(df, a, order, replicates, seed).select("rep", F.col("std").alias("sa"))
    two = _replicate_moments(df, b, order, replicates, seed + 1).select("rep", F.col("std").alias("sb"))
    gap = one.join(two, "rep").select((F.col("sa") - F.col("sb")).alias("gap"))
    return gap.agg(*_interval("gap", level))


def sharpe_bounds(intervals: DataFrame, periods: int = 252) -> DataFrame:
    """Rough bounds: best mean over lowest deviation, and the reverse."""
    root = F.sqrt(F.lit(float(periods)))
    return intervals.select(
        "*",
        (root * F.col("mean_low") / F.col("std_high")).alias("sharpe_low"),
        (root * F.col("mean_high") / F.col("std_low")).alias("sharpe_high"),
    )
