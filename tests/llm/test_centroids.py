import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import centroids


def brute(rows, k, rounds):
    """Plain integers, all distances."""
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    ordered = sorted(kept, key=lambda r: (name(r), list(centroids.hadamard(np.array([r[1]], dtype=object))[0, centroids.ORDER])))
    centres = [e for _, e in ordered[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    pick = lambda e: min((far(e, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        home = [pick(e)[1] for _, e in kept]
        for n in range(len(centres)):
            mine = [e for (_, e), h in zip(kept, home, strict=True) if h == n]
            if mine:
                centres[n] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    return sorted(((i, *reversed(pick(e))) for i, e in kept), key=repr), centres


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    a = rng.integers(-500, 500, (30, 64))
    b = centroids.hadamard(a)
    assert (((a[:1] - a) ** 2).sum(axis=1) * 64 == ((b[:1] - b) ** 2).sum(axis=1)).all()
    assert (centroids.hadamard(b) == 64 * a).all()
    changes = (np.diff(centroids.hadamard(np.eye(64, dtype=np.int64))[centroids.ORDER], axis=1) != 0).sum(axis=1)
    assert list(changes) == list(range(64))


def test_search_is_exact_with_ties():
    rng = np.random.default_rng(2)
    points, centres = rng.integers(-3, 4, (300, 64)), rng.integers(-3, 4, (40, 64))
    centres[30:] = centres[:10]
    points[:40] = centres
    found, distance = centroids.nearest(centroids.hadamard(points)[:, centroids.ORDER], centroids.hadamard(centres)[:, centroids.ORDER])
    want = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (found == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()


@pytest.mark.parametrize("n, k", [(300, 40), (25, 40), (60, 1)])
def test_against_brute_force(spark, n, k):
    rng = random.Random(n)
    hubs = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(hubs)]) for i in range(n)]
    rows += [(5, rows[5][1]), (7, rows[8][1]), (900, rows[0][1]), (None, rows[1][1])]
    rows += [(1001, None), (1002, [1.0] * 63), (1003, [1.0] * 65), (1004, [1.0] * 63 + [None]), (1005, [float("nan")] * 64), (1006, [0.0] * 63 + [float("-inf")]), (1007, [])]
    got = centroids.cluster(table(spark, rows).withColumn("cluster", F.lit("x")).withColumn("coefs", F.lit(1)), k)
    want, centres = brute(rows, k, 5)
    assert got.centres == centres
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got.assigned.collect()), key=repr) == want
    out = centroids.digest(got)
    assert out.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    rows = out.collect()
    assert len(rows) == len(want) and {r["inertia"] for r in rows} == {sum(w[2] for w in want)}
    for r in rows:
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_large_components_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.choice([0, 4, 5]) for _ in range(64)]) for i in range(20)]
    got = centroids.cluster(table(spark, rows), 4, 2)
    want, centres = brute(rows, 4, 2)
    assert got.centres == centres
    assert sorted((tuple(r) for r in got.assigned.collect()), key=repr) == want


def test_empty_and_equal_vectors(spark):
    assert centroids.digest(centroids.cluster(table(spark, []))).count() == 0
    got = centroids.cluster(table(spark, [(i, [0.5] * 64) for i in range(100)]))
    assert len(got.centres) == 40 and got.counts == [100] + [0] * 39 and got.inertias == [0] * 40
