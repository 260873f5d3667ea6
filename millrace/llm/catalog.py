"""The registered queries over the driver tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import centroids, chat, decontaminate, divergence, extraction, importance, language, lines, minhash, oracles, packing, sharding, textscan, toxicity, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op6_minhash": oracles.OP6, "op9_decontaminate": oracles.OP9, "op10_lines": oracles.OP10, "op4_vectors": oracles.OP4, "op11_chat": oracles.OP11, "op12_centroids": oracles.OP12, "op13_divergence": oracles.OP13}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        textscan.small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.decontaminate(docs, items))


@query
def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).drop("group")


@query
def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_lines(table(spark, sf_dir, "documents"))
    digest = F.md5(F.coalesce("text", F.lit("")))
    return found.select("doc_id", "source", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars_left"), digest.alias("text_md5"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(language.training(docs)))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.learn(docs, labels))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages))


@query
def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chat.as_log(table(spark, sf_dir, "conversations"))
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.render(log.union(chat.as_log(probe)), each=True))


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(centroids.cluster(table(spark, sf_dir, "embeddings")))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
