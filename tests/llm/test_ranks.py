import random

import pytest

from millrace.llm.components import components
from millrace.llm.ranks import bucket, largest, rank_within


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    for n, m in ((1, 1), (40, 20), (200, 190), (300, 900)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(1000, 1030)]
        edges += [(0, 0), (None, 3)]
        parent = {}

        def root(x, parent=parent):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a is not None and a != b:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
        got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: root(x) for x in parent}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ranks_are_gapless(spark):
    rows = spark.createDataFrame([(k, "hot" if k % 3 else f"k{k % 7}") for k in range(500)], "row long, k string")
    got = rank_within(rows.withColumn("part", bucket("row", n=16)), ["k"], "part", ["row"], "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r["k"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == 500


@pytest.mark.parametrize("k", [0, 1, 7, 50, 120, 199, 200, 300])
def test_largest_takes_exactly_k(spark, k):
    rng = random.Random(k)
    rows = [(i, rng.choice([1.5, 1.5, 1e-9, -3.0, rng.random() * 1e6, 7.25])) for i in range(200)]
    df = spark.createDataFrame(rows, "row long, v double")
    got = {r["row"] for r in df.where(largest(df, "v", "row", k)).collect()}
    assert got == {i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]}


def test_largest_of_nothing(spark):
    df = spark.createDataFrame([], "row long, v double")
    assert df.where(largest(df, "v", "row", 3)).count() == 0
