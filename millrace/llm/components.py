"""Connected components of an edge table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _towards_smallest(pairs: DataFrame) -> DataFrame:
    """Every pair with ``m``, the smallest of its near end and that end's neighbours.

    The minimum is aggregated before it is joined back, so a vertex with any
    number of neighbours is never gathered in one place.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    return pairs.join(least.select("a", F.least("a", "m").alias("m")), "a")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex is either a centre or tied to one centre only."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("centre"))
    ends = ends.union(edges.select(F.col("b").alias("v"), F.lit(0), F.lit(1)))
    roles = ends.groupBy("v").agg(F.sum("child").alias("child"), F.max("centre").alias("centre"))
    return roles.where((F.col("child") > 1) | ((F.col("child") > 0) & (F.col("centre") > 0))).isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``id``, ``component`` (smallest reachable id) for every end of an edge.

    ``edges``: whole-number columns ``a`` and ``b``; loops and repeats are harmless,
    a null end drops the edge. Large-star and small-star steps alternate until the
    edges are stars; each round is staged. Raises if that takes over ``rounds`` rounds.
    """
    work = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    for _ in range(rounds):
        if _are_stars(work):
            break
        large = _towards_smallest(_both(work)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = _towards_smallest(large.where("a > b"))
        small = star.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        work = stage(small.where("a > b").distinct())
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("component")), F.struct(F.col("b").alias("id"), F.col("b").alias("component"))))
    return work.select(ends.alias("e")).select("e.*").distinct()
