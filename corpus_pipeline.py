"""From raw documents to packed sequences.

Each stage takes what the stage before has kept; all but the last return the columns of
``documents``. Text is judged and cut as it is when it reaches a stage.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import wraps

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.llm import decontaminate, lines, minhash, packing, textscan, toxicity  # noqa: E402
from millrace.session import stage  # noqa: E402


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _small(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Whole texts go to Python in small batches."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        textscan.small_batches(spark)
        return step(spark, docs, sf_dir)

    return run_step


@_small
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.reject(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


@_small
def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines; ``n_chars`` follows the text."""
    cut = lines.drop_lines(docs, host="source").select(*docs.columns)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


@_small
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return minhash.keep_one(docs)


@_small
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


@_small
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Learned scores, MinHash and tokenizers are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
