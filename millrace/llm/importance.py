"""Importance resampling with hashed n-gram models.

Words and word pairs are hashed into ``2 ** BITS`` buckets. Two multinomial models over
them are counted: one on documents that are labelled good, one on all documents. A
document's log weight is the sum of the log ratio of the two over its n-grams;
adding Gumbel noise and taking the largest k samples k documents without
replacement in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textscan
from millrace.llm.ranks import largest
from millrace.session import stage

BITS = 14
TARGET_ROWS = 20_000  # labelled documents that the target model is counted on, at most
SHARE = 0.5
SMOOTHING = 1.0


def _buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and the row of each."""
    words = textscan.scan(column, textscan.SPACED)
    owner = words.owner()
    pair, whole = textscan.grams(words, 2)
    shift = np.uint64(64 - BITS)
    return (
        np.concatenate([words.hash >> shift, pair[whole] >> shift]).astype(np.int64),
        np.concatenate([owner, owner[whole]]),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << BITS
    total = np.zeros((2, size), dtype=np.int64)
    for batch in batches:
        for part in textscan.pieces_of(batch, "text", 2 << 20):
            place, owner = _buckets(part.column("text"))
            chosen = part.column("target").to_numpy(zero_copy_only=False).astype(bool)[owner]
            total[0] += np.bincount(place, minlength=size)
            total[1] += np.bincount(place[chosen], minlength=size)
    seen = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[0, seen]), pa.array(total[1, seen])], names=["bucket", "raw", "target"])


def _weigh(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textscan.pieces_of(batch, "text", 2 << 20):
                place, owner = _buckets(part.column("text"))
                weight = np.bincount(owner, weights=ratio[place], minlength=part.num_rows).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(weight)], names=["doc_id", "text_key", "log_weight"])

    return run


def target_sample(labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """At most ``rows`` ids of documents labelled good, by hash of the id; at most 16 bytes each."""
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id")


def log_ratio(docs: DataFrame, labels: DataFrame, rows: int = TARGET_ROWS) -> np.ndarray:
    """Log ratio of the two models by bucket; the driver gets a row per bucket."""
    sample = F.broadcast(target_sample(labels, rows).withColumn("target", F.lit(True)))
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(sample, "doc_id", "left")
    counted = marked.select("text", F.coalesce("target", F.lit(False)).alias("target")).mapInArrow(_count, "bucket long, raw long, target long")
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for place, n, m in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[place], target[place] = n, m
    shares = [np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * len(x))) for x in (target, raw)]
    return shares[0] - shares[1]


def gumbel(*by: str | Column) -> Column:
    """Standard Gumbel noise by hash."""
    u = (F.pmod(F.xxhash64(*by, F.lit(1)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, rows: int = TARGET_ROWS) -> DataFrame:
    """Log weight of every document, and whether it is among the sampled ``share`` of them.

    ``docs``: ``doc_id``, ``text``; ``labels``: ``doc_id``, ``quality`` (1 is good). A row per
    row of ``docs`` with ``doc_id``, ``log_weight``, ``sample_key`` (weight plus noise) and
    ``selected``; exactly ceil(share * rows) are selected, ties by row. Null and empty texts
    weigh 0. Without good labels the two models differ by smoothing only.
    """
    ratio = log_ratio(docs, labels, rows)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    weighed = docs.select("doc_id", F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"))
    weighed = weighed.mapInArrow(_weigh(ratio), f"doc_id {kind}, text_key long, log_weight double")
    scored = stage(weighed.withColumn("row", F.monotonically_increasing_id()).withColumn("sample_key", F.col("log_weight") + gumbel("doc_id", "text_key")))
    k = -int(-share * scored.count() // 1)
    chosen = largest(scored, "sample_key", "row", k)
    return scored.select("doc_id", "log_weight", "sample_key", chosen.alias("selected"))
