"""Keyed joins and group statistics that hold up under skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import max_group_rows, stage


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest key; one map-side combined job, key columns only."""
    if not keys:
        return df.count()
    top = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return int(top or 0)


# Stands for the frame on which keys are measured: ``gather`` has found that they fit.
GATHERED = "gathered"


def gather(df: DataFrame, keys: Sequence[str], sizes: DataFrame | None = None) -> tuple[DataFrame, str | None]:
    """Rows of a key in one task, by one shuffle, and the mark that tells later steps so.

    Windows over these keys, or finer ones, then need no shuffle, and statistics of their
    groups neither a table nor a join. If a key has more rows than a task may hold, the frame
    stays as it is and there is no mark: each step measures and splits its own keys.
    """
    if largest_group(df.select(*keys) if sizes is None else sizes, keys) > max_group_rows(df.sparkSession):
        return df, None
    return df.repartition(*keys), GATHERED


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = True
) -> DataFrame:
    """Equi join on same-named keys that keeps the left key columns.

    With ``null_safe`` a null key matches a null key, which joining group
    statistics back to their own rows needs. No hint is given: AQE broadcasts
    the right side only when its measured size allows, and splits skewed
    partitions otherwise.
    """
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        pair = left[k].eqNullSafe(renamed[f"__r_{k}"]) if null_safe else left[k] == renamed[f"__r_{k}"]
        cond = pair if cond is None else cond & pair
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def attach(
    df: DataFrame, keys: Sequence[str], stats: dict[str, Column], source: DataFrame | None = None, sizes: DataFrame | str | None = None
) -> DataFrame:
    """Add whole-group statistics to every row.

    Aggregates first (partial sums on the map side) and joins the small result
    back, so a key with a third of the rows never sits in one window partition.
    The result is staged: its file size is then known when the join is planned,
    and a table under the broadcast threshold spares the rows a shuffle.
    ``source`` names a cheaper frame of the same rows to aggregate, so that a
    chain of these calls does not run its upstream plan again and again. Rows that
    ``gather`` has brought together get plain aggregates as windows over their group.
    """
    if sizes is GATHERED:
        group = Window.partitionBy(*keys)
        return df.withColumns({n: c.over(group) for n, c in stats.items()})
    source = df if source is None else source
    cols = [c.alias(n) for n, c in stats.items()]
    if not keys:
        one = source.agg(F.struct(*cols).alias("s")).scalar()
        return df.withColumns({n: one[n] for n in stats})
    return join_on(df, stage(source.groupBy(*keys).agg(*cols)), keys, "left")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    condition: Column | None = None,
    limit: int | None = None,
    coarse: Sequence[str] = (),
) -> DataFrame:
    """Equi join (``inner`` or ``left``) with hot left keys spread over salts.

    Keys with more than ``limit`` left rows get ``ceil(rows / limit)`` salts;
    right rows of those keys are copied once per salt. There are at most
    ``total / limit`` such keys, which bounds the salt table. Right-hand key
    columns are dropped; ``condition`` may use columns of both sides. ``coarse`` names
    those of the keys that are cheap to work out: if their groups fit, the others aren't measured.
    """
    limit = limit or max_group_rows(left.sparkSession)
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        pair = left[k] == named[f"__r_{k}"]
        cond = pair if cond is None else cond & pair
    full = cond if condition is None else cond & condition
    if coarse and largest_group(left, coarse) <= limit or largest_group(left, keys) <= limit:
        return left.join(named, full, how).drop(*[f"__r_{k}" for k in keys])

    hot = (
        left.groupBy(*keys)
        .count()
        .filter(F.col("count") > limit)
        .select(*keys, F.ceil(F.col("count") / F.lit(limit)).cast("int").alias("__salts"))
    )
    spread = join_on(left, hot, keys, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*left.columns), F.coalesce(F.col("__salts"), F.lit(1))).cast("int")
    ).drop("__salts")
    hot_r = hot.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    copies = join_on(named, hot_r, [f"__r_{k}" for k in keys], "left").withColumn(
        "__r_salt",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - F.lit(1))),
    ).drop("__salts")
    cond = F.col("__salt") == F.col("__r_salt")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__r_{k}"))
    if condition is not None:
        cond = cond & condition
    return spread.join(copies, cond, how).drop("__salt", "__r_salt", *[f"__r_{k}" for k in keys])


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``.

    ``min_by`` keeps a single row per key on the map side, unlike a
    ``row_number`` window that ships every row of a key to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*").select(*df.columns)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group; Spark limits each map task to ``k`` per group first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
