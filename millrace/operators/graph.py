"""Vertices, edges, degrees and PageRank, all periods in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import full_counts
from millrace.operators.keyed import join_on
from millrace.operators.windows import lag_metric
from millrace.session import stage


def vertices(
    df: DataFrame, period: str, src: dict[str, str], dst: dict[str, str], key: str = "id"
) -> DataFrame:
    """One row per period and vertex; attributes of the source end win.

    ``src`` and ``dst`` map the output columns, ``key`` among them, to the
    columns of each end.
    """
    ends = []
    for rank, names in enumerate((src, dst)):
        ends.append(df.select(period, *[F.col(c).alias(n) for n, c in names.items()], F.lit(rank).alias("__p")))
    rest = [n for n in src if n != key]
    both = ends[0].unionByName(ends[1])
    best = F.min_by(F.struct(*rest), F.struct("__p", *rest)).alias("__row")
    return both.groupBy(period, key).agg(best).select(period, key, "__row.*")


def edge_weights(df: DataFrame, period: str, src: str, dst: str, weight: str) -> DataFrame:
    """One row per period and pair with the mean weight."""
    return df.groupBy(period, F.col(src).alias("src"), F.col(dst).alias("dst")).agg(F.avg(weight).alias("weight"))


def degrees(df: DataFrame, period: str, src: str, dst: str) -> DataFrame:
    """Edges in and out per period and vertex; repeated edges count each time."""
    into = df.groupBy(period, F.col(dst).alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))
    out = df.groupBy(period, F.col(src).alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))
    return full_counts(into, out, [period, "id"], ["in_degree", "out_degree"])


def pagerank(
    edges: DataFrame,
    period: str,
    src: str = "src",
    dst: str = "dst",
    reset: float = 0.15,
    tolerance: float | None = 1e-4,
    rounds: int = 100,
    stage_every: int = 4,
) -> DataFrame:
    """Rank per period and vertex over distinct pairs, all periods at once.

    ``rank = reset + (1 - reset) * sum(rank / out_degree)``, from 1, until no
    rank moves by more than ``tolerance`` (an error if that takes over ``rounds``
    rounds; exactly ``rounds`` rounds with ``None``), then scaled per period so that ranks sum to the vertex count.
    Rounds are staged so that neither plan nor lineage grows.
    """
    pairs = edges.select(period, F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    out = pairs.groupBy(period, "src").agg(F.count(F.lit(1)).alias("out_n"))
    links = stage(join_on(pairs, out, [period, "src"], "left"))
    nodes = stage(
        links.select(period, F.col("src").alias("id")).union(links.select(period, F.col("dst").alias("id"))).distinct()
    )
    ranks = nodes.withColumn("rank", F.lit(1.0))
    for i in range(1, rounds + 1):
        sent = links.join(ranks.withColumnRenamed("id", "src"), [period, "src"])
        got = sent.groupBy(period, F.col("dst").alias("id")).agg(F.sum(F.col("rank") / F.col("out_n")).alias("got"))
        fresh = nodes.join(got, [period, "id"], "left").select(
            period, "id", (F.lit(reset) + F.lit(1 - reset) * F.coalesce("got", F.lit(0.0))).alias("rank")
        )
        if tolerance is None:
            ranks = stage(fresh) if i % stage_every == 0 and i < rounds else fresh
            continue
        fresh = stage(fresh)
        moved = fresh.join(ranks.withColumnRenamed("rank", "was"), [period, "id"])
        delta = moved.agg(F.max(F.abs(F.col("rank") - F.col("was")))).first()[0]
        ranks = fresh
        if delta is None or delta <= tolerance:
            break
    else:
        if tolerance is not None:
            raise RuntimeError(f"ranks still move by {delta:.2g} after {rounds} rounds; the tolerance is {tolerance:.2g}")
    totals = ranks.groupBy(period).agg((F.count(F.lit(1)) / F.sum("rank")).alias("scale"))
    return ranks.join(totals, period).select(period, "id", (F.col("rank") * F.col("scale")).alias("pagerank"))


def attach_end_metrics(
    df: DataFrame, metrics: DataFrame, period: str, ends: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Add this and last period's vertex metrics to both ends of each edge row.

    A vertex without an earlier period gets this period's value as its lag.
    """
    lagged = lag_metric(metrics.select(period, "id", *cols), "id", period, cols)
    for end in ends:
        names = {c: f"{end}_{c}" for c in [*cols, *[f"{c}_lag" for c in cols]]}
        side = lagged.withColumnsRenamed({**names, "id": end})
        df = join_on(df, side, [end, period], "left", null_safe=False)
    return df
