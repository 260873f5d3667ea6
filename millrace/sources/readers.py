"""Readers for tables, text, nested trees and overlapping batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.keyed import join_on
from millrace.operators.ordered import following


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet; filters and column lists reach the files."""
    return spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, infer: bool = False
) -> DataFrame:
    """CSV with header from a glob or a list of files, ``.gz`` included.

    All columns are text unless a schema is given. ``infer`` reads the data a
    further time. A gzip file is one task; repartition after reading large ones.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_any(spark: SparkSession, fmt: str, path: str, **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def period_paths(pattern: str, years: Sequence[int], months: Sequence[int]) -> list[str]:
    """One path per year and month from a pattern with ``{year}`` and ``{month}``."""
    return [pattern.format(year=y, month=m) for y in years for m in months]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line."""
    return spark.read.text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, whole: bool = False) -> DataFrame:
    """JSON lines, or one document per file with ``whole``."""
    reader = spark.read.option("multiLine", whole)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def flatten_tree(df: DataFrame, children: str = "c", depth: str = "d", max_depth: int = 3) -> DataFrame:
    """All nodes of nested ``children`` arrays as flat rows.

    A node's children are followed while its depth is under ``max_depth`` and
    the schema still nests.
    """
    level = df.select(F.explode(children).alias("n"))
    found = None
    while True:
        node = level.schema["n"].dataType
        plain = [f.name for f in node.fields if f.name != children]
        rows = level.select(*[F.col(f"n.{c}").alias(c) for c in plain])
        found = rows if found is None else found.unionByName(rows)
        below = node[children].dataType if children in node.names else None
        # Always-empty children are read as arrays of text.
        if not isinstance(below, T.ArrayType) or not isinstance(below.elementType, T.StructType):
            return found
        level = level.filter(F.col(f"n.{depth}") < max_depth).select(F.explode(f"n.{children}").alias("n"))


def merge_batches(
    df: DataFrame, symbol: str, time: str, batch: str, end=None
) -> DataFrame:
    """One series per symbol from overlapping batches.

    Rows of a batch stay only before the first time of any later batch, and up
    to ``end``. The cut per batch comes from a table of batch starts.
    """
    starts = df.groupBy(symbol, batch).agg(F.min(time).alias("__start"))
    cuts = following(starts, [symbol], [batch], {"__cut": ("min", F.col("__start"))}, include_current=False)
    out = join_on(df, cuts.drop("__start"), [symbol, batch], "left")
    out = out.filter(F.col("__cut").isNull() | (F.col(time) < F.col("__cut"))).drop("__cut")
    return out if end is None else out.filter(F.col(time) <= end)
