"""Samples, splits, slices and small results for reports."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows


def unit_hash(key: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) from key and seed; the same on every engine and partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def bernoulli(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Keep each row with the given probability, decided by its key alone."""
    return df.filter(unit_hash(key, seed) < fraction)


def random_split(df: DataFrame, shares: dict[str, float], key: Sequence[str], seed: int = 42) -> DataFrame:
    """Label every row with one of the parts, by shares of the unit interval."""
    total, edge, label = sum(shares.values()), 0.0, None
    names = list(shares)
    u = unit_hash(key, seed)
    for name in names[:-1]:
        edge += shares[name] / total
        label = F.when(u < edge, name) if label is None else label.when(u < edge, name)
    label = F.lit(names[-1]) if label is None else label.otherwise(names[-1])
    return df.withColumn("part", label)


def first_rows(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """Some ``n`` rows for a dry run, or the first ``n`` in an order."""
    return df.limit(n) if order is None else df.orderBy(*order).limit(n)


def slice_rows(df: DataFrame, order: Sequence[str], start: int, stop: int | None = None) -> DataFrame:
    """Rows by 0-based position in an order, ``stop`` left out."""
    rows = number_rows(df, [], list(order), "__rn")
    keep = F.col("__rn") > start if stop is None else F.col("__rn").between(start + 1, stop)
    return rows.filter(keep).drop("__rn")


def report(df: DataFrame, n: int = 1000) -> pd.DataFrame:
    """At most ``n`` rows on the driver, for printing or plotting."""
    return df.limit(n).toPandas()
