"""Unions, ordered lists and set differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.keyed import attach


def stack(frames: Sequence[DataFrame], missing: bool = True) -> DataFrame:
    """Union by name; columns one side lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def stack_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def stack_sources(frames: Sequence[DataFrame], name: str = "source_no") -> DataFrame:
    """Union with the number of the source frame, to keep their order."""
    return stack([df.withColumn(name, F.lit(i)) for i, df in enumerate(frames)])


def first_occurrences(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each key once, with the smallest position it occurs at."""
    first = F.min(F.struct(*order)).alias("__at")
    return df.groupBy(*keys).agg(first).select(*keys, "__at.*")


def remove_matching(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(~F.col(col).rlike(pattern))


def remove_listed(df: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(listed.select(*on).distinct(), list(on), "left_anti")


def trim_ends(df: DataFrame, keys: Sequence[str], pos: str, head: int = 0, tail: int = 0) -> DataFrame:
    """Drop the first ``head`` and last ``tail`` entries of each ordered list.

    Positions count from 1 without gaps in each list.
    """
    out = attach(df, keys, {"__last": F.max(pos)})
    return out.filter((F.col(pos) > head) & (F.col(pos) <= F.col("__last") - tail)).drop("__last")


def with_heads(df: DataFrame, heads: DataFrame, pos: str) -> DataFrame:
    """Put fixed entries in front of the lists; heads carry positions from 0 downwards."""
    return df.unionByName(heads.select(*df.columns))
