"""Writers and the on-disk size of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, overwrite: bool = False, by: Sequence[str] = ()) -> None:
    """Parquet; fails on an existing path unless told to overwrite. ``by`` makes partition folders."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_lines(df: DataFrame, line: Column, path: str, append: bool = True) -> None:
    """One line of text per row."""
    df.select(line.cast("string").alias("value")).write.mode("append" if append else "errorifexists").text(path)


def disk_size(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes under a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
