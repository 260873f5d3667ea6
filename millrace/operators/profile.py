"""Profiles of whole tables, each in one aggregate job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _missing(df: DataFrame, col: str) -> Column:
    """Null, or empty where the column is text."""
    empty = F.col(col) == "" if isinstance(df.schema[col].dataType, T.StringType) else F.lit(False)
    return F.col(col).isNull() | empty


def null_percentages(df: DataFrame, digits: int = 2) -> DataFrame:
    """One row: percentage of null or empty values of every column."""
    n = F.nullif(F.count(F.lit(1)).cast("double"), F.lit(0.0))
    return df.agg(
        *[F.round(F.lit(100.0) * F.count_if(_missing(df, c)) / n, digits).alias(c) for c in df.columns]
    )


def keep_columns(df: DataFrame, max_null_pct: float, leakage: Sequence[str] = ()) -> DataFrame:
    """Columns at or under the null percentage that are not on the leakage list."""
    pct = null_percentages(df, 12).first().asDict()  # one row
    return df.select(*[c for c in df.columns if (pct[c] or 0.0) <= max_null_pct and c not in leakage])


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)


def distinct_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of distinct value combinations."""
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


def summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min and max, one row per column."""
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in cols
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
