"""Exact quantiles that are values of the column, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.keyed import GATHERED, attach, join_on
from millrace.operators.ordered import running
from millrace.session import stage


def _rank(rows: Column, share: float) -> Column:
    """Place of a quantile among ``rows`` values in order, in decimals."""
    return F.greatest(F.lit(1), F.ceil(rows.cast("decimal(20,0)") * F.lit(Decimal(str(share)))))


def discrete_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], keys: Sequence[str] = ()) -> DataFrame:
    """A row per group with the columns of ``wanted``: a name for each (column, share).

    A quantile is the smallest value that, with all up to it, makes that share of the group's
    values; nulls don't count, and a group without values has null. Rows are reduced to counts of
    distinct values before they move, and totals run over these, so that neither many rows
    nor many values of one group meet in one task. Ranks are found in decimals: a share of 0.3
    of ten values is the third.
    """
    keys = list(keys)
    out = None
    for col in dict.fromkeys(c for c, _ in wanted.values()):
        counts = stage(df.groupBy(*keys, F.col(col).alias("__value")).agg(F.count(col).alias("__n")))
        upto = running(counts, keys, [F.asc_nulls_first("__value")], {"__upto": ("sum", F.col("__n"))})
        upto = attach(upto, keys, {"__all": F.sum("__n")}, source=counts)
        picks = {n: F.min(F.when(F.col("__upto") >= _rank(F.col("__all"), p), F.col("__value"))).alias(n) for n, (c, p) in wanted.items() if c == col}
        found = upto.groupBy(*keys).agg(*picks.values())
        if out is None:
            out = found
        elif keys:
            out = join_on(out, found, keys)
        else:
            out = out.withColumns({n: found.select(n).scalar() for n in picks})
    return out.select(*keys, *wanted)


def attach_quantiles(df: DataFrame, keys: Sequence[str], wanted: dict[str, tuple[str, float]], sizes: str | None = None) -> DataFrame:
    """Every row with the quantiles of its group, or of all rows without keys.

    Groups that ``gather`` has brought together are sorted where they are.
    """
    if sizes is GATHERED:
        group, out = Window.partitionBy(*keys), df
        for col in dict.fromkeys(c for c, _ in wanted.values()):
            grow = group.orderBy(F.asc_nulls_first(col)).rowsBetween(Window.unboundedPreceding, 0)
            out = out.withColumn("__upto", F.count(col).over(grow)).withColumn("__all", F.count(col).over(group))
            picks = {n: F.when(F.col("__upto") >= _rank(F.col("__all"), p), F.col(col)) for n, (c, p) in wanted.items() if c == col}
            out = out.withColumns({n: F.min(v).over(group) for n, v in picks.items()}).drop("__upto", "__all")
        return out
    found = discrete_quantiles(df, wanted, keys)
    if keys:
        return join_on(df, found, list(keys), "left")
    one = found.select(F.struct(*wanted).alias("s")).scalar()
    return df.withColumns({n: one[n] for n in wanted})
