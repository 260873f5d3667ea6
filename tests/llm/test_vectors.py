import numpy as np
import pytest

from millrace.llm import vectors

INF, NAN = float("inf"), float("nan")


def brute(rows, threshold=0.93):
    ok = [l is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unit = [np.array(v, float) / np.abs(v).max() if g else None for g, (_, v, _) in zip(ok, rows, strict=True)]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and (unit[i] @ unit[j] >= threshold or rows[i][1] == rows[j][1]):
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)), key=lambda k: (rows[k][0] is None, rows[k][0], k))
                root[y] = x
    return sorted(((r[0], links[i], rows[find(i)][0], r[0] == rows[find(i)][0]) for i, r in enumerate(rows)), key=repr)


def result(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 class", "2 t", "3 a", "4 row")
    return sorted((tuple(r) for r in vectors.near_vectors(df).collect()), key=repr)


def rounded(v):
    return [float(np.float32(x)) for x in v]


def test_odd_rows(spark):
    rows = [
        (0, None, 1), (1, [], 1), (2, [0.0, 0.0], 1), (3, [NAN, 1.0], 1), (4, [INF, 1.0], 1), (5, [None, 1.0], 1), (6, [1.0, 0.0], None),
        (7, [1.0, 0.0], 1), (8, [2.0, 0.0], 1), (9, [1.0, 0.0], 2), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [-1.0, 0.0], 1), (13, [1e30, 1e28], 1), (14, [1.0, 0.0], 2), (14, [1.0, 0.0], 2),
    ]
    assert result(spark, rows) == brute(rows)


def test_empty_and_unusable_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(3, None, 1), (4, [1.0], None)]) == [(3, 0, 3, True), (4, 0, 4, True)]


@pytest.mark.parametrize("size", [8, 64, 100])
def test_recall_against_brute_force(spark, size):
    rng = np.random.default_rng(size)
    rows = []
    for k in range(60):
        base = rng.normal(size=size)
        for _ in range(rng.integers(1, 12)):
            v = base + rng.normal(size=size) * rng.uniform(0, 0.45)
            rows.append((len(rows), rounded(v), int(k % 3)))
    want, got = brute(rows), result(spark, rows)
    found, every = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert found >= (0.97 if size <= 64 else 0.9) * every and every > 100


def test_codes_are_balanced(spark):
    rng = np.random.default_rng(0)
    sample = rng.normal(size=(2000, 64))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    sample -= sample.mean(axis=0)
    turn = vectors.learn_rotation(sample, 64, 1)
    assert np.allclose(turn.T @ turn, np.eye(64), atol=1e-8)
    assert (abs((sample @ turn >= 0).mean(axis=0) - 0.5) < 0.1).all()


def test_learning_lowers_the_loss():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(1500, 64)) * np.linspace(0.2, 3, 64)
    loss = lambda t: float(((np.where(sample @ t >= 0, 1, -1) - sample @ t) ** 2).sum())
    start = np.linalg.eigh(sample.T @ sample)[1]
    assert loss(vectors.learn_rotation(sample, 64, 1)) < loss(start)


def test_tables_follow_the_rows():
    assert vectors.shape(10) == (16, 4)
    assert vectors.shape(1 << 22)[0] == 22 and vectors.shape(1 << 22)[1] > 4


def directed(rng, size, mean_cosine, bases, pairs):
    """Unit vectors with a common direction, and pairs of them with a cosine of 0.93 to 0.95."""
    common = np.eye(size)[0]
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    side = lambda n: unit(np.concatenate([np.zeros((n, 1)), rng.normal(size=(n, size - 1))], axis=1))
    rest = side(bases)
    x = np.sqrt(mean_cosine) * common + np.sqrt(1 - mean_cosine) * rest
    own = rest[:pairs]
    way = side(pairs)
    way = unit(way - np.einsum("ij,ij->i", way, own)[:, None] * own)
    inner = (rng.uniform(0.93, 0.95, size=pairs) - mean_cosine) / (1 - mean_cosine)
    turned = inner[:, None] * own + np.sqrt(1 - inner**2)[:, None] * way
    return x, np.sqrt(mean_cosine) * common + np.sqrt(1 - mean_cosine) * turned


@pytest.mark.parametrize("mean_cosine, size, total", [(0.0, 64, 3 * 10**7), (0.5, 64, 3 * 10**7), (0.5, 384, 10**6), (0.8, 64, 10**6)])
def test_recall_with_a_common_direction_and_many_rows(mean_cosine, size, total):
    """As many tables as ``total`` rows take; a pair is met if two bits differ at most in a chunk, and not too many in all."""
    rng = np.random.default_rng(3)
    x, y = directed(rng, size, mean_cosine, 3000, 600)
    known = np.concatenate([x, y])
    mean, rotation, chunk, tables, most = vectors.plan(known, np.full(len(known), size), total)
    assert rotation.shape[1] == chunk * tables
    differ = ((x[:600] - mean) @ rotation >= 0) != ((y - mean) @ rotation >= 0)
    met = (differ.reshape(600, tables, chunk).sum(axis=2) <= 2).any(axis=1) & (differ.sum(axis=1) <= most)
    assert met.mean() >= 0.97


def test_links_with_a_common_direction(spark):
    x, y = directed(np.random.default_rng(4), 64, 0.8, 900, 300)
    rows = [(k, rounded(v), 1) for k, v in enumerate(np.concatenate([x, y]))]
    want, got = brute(rows), result(spark, rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want) > 500


def test_all_pairs_where_probing_takes_more(spark):
    """Nearly equal vectors: after centring, pairs at the threshold are as far apart as any."""
    rng = np.random.default_rng(5)
    rows = [(k, rounded(np.eye(32)[0] + 0.04 * rng.normal(size=32)), k % 2) for k in range(300)]
    assert result(spark, rows) == brute(rows)


def test_exploded_tables_and_pairs_are_not_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(4)
    planned = []
    stage = vectors.stage
    monkeypatch.setattr(vectors, "stage", lambda df: (planned.append(df._jdf.queryExecution().sparkPlan().toString()), stage(df))[1])
    for n in (60, 400):  # all pairs of a label, probed tables
        rows = spark.createDataFrame([(k, rounded(rng.normal(size=64)), 1) for k in range(n)], "vec_id long, embedding array<float>, label int")
        vectors.near_vectors(rows).collect()
    joins = [p for p in planned if "Join" in p]
    assert len(joins) >= 4 and sum("Generate explode" in p for p in joins) == 2
    assert not any("Broadcast" in p for p in joins if "Generate explode" in p or "MapInArrow" in p)
