import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import graph, sampling
from millrace.operators import statistics as st
from millrace.operators import windows as win
from millrace.plans.tables import legs


def test_divergence_known_answer(spark):
    rows = [("a", 0.1, 0.8), ("b", 0.4, 0.15), ("c", 0.5, 0.05)]
    row = st.discrete_kl(spark.createDataFrame(rows, "k string, p double, q double"), "k", "p", "q").first()
    assert (round(row.kl_pq, 3), round(row.kl_qp, 3)) == (1.336, 1.401)


def test_divergence_of_equal_samples_is_zero(spark):
    df = spark.range(500).select((F.col("id") % 97).cast("double").alias("v"), F.explode(F.array(F.lit("p"), F.lit("q"))).alias("s"))
    row = st.kl_divergence(df, "v", "s", "p", "q").first()
    assert row.kl_pq == pytest.approx(0, abs=1e-12) and row.kl_qp == pytest.approx(0, abs=1e-12)


def test_mean_returns(spark):
    row = st.mean_returns(spark.createDataFrame([("a", 0.5), ("a", -0.5)], "k string, r double"), ["k"], "r").first()
    assert row.arithmetic == 0 and row.geometric == pytest.approx(math.sqrt(0.75) - 1)


def test_scores(spark):
    rows = [(1, 1)] * 2 + [(0, 1)] + [(1, 0)] + [(0, 0)] * 4
    row = agg.confusion_scores(spark.createDataFrame(rows, "y int, p int"), "y", "p").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 4)
    assert all(row[c] == pytest.approx(2 / 3) for c in ("precision", "recall", "f1", "f2"))
    none = agg.confusion_scores(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert (none.precision, none.recall, none.f1, none.f2) == (0, 0, 0, 0)


def test_exact_quantiles_match_numpy(spark):
    x = np.round(np.random.default_rng(3).normal(size=501), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = st.exact_quantiles(df, "x", [0, 0.1, 0.33, 0.5, 0.99, 1]).first()["q"]
    assert got == pytest.approx(np.quantile(x, [0, 0.1, 0.33, 0.5, 0.99, 1]).tolist())


def test_spearman_matches_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    df = spark.range(300).select((F.col("id") * 37 % 11).cast("double").alias("a"), (F.col("id") * F.col("id") % 23).cast("double").alias("b"))
    got = {(r.a, r.b): r["corr"] for r in st.spearman_matrix(df, ["a", "b"]).collect()}
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    want = Correlation.corr(vec, "v", "spearman").first()[0].toArray()
    assert got[("a", "b")] == pytest.approx(want[0, 1]) and got[("a", "a")] == pytest.approx(1)


def test_bootstrap_is_stable_and_covers(spark):
    x = np.random.default_rng(5).normal(0.01, 0.2, 400)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, r double")
    one = st.bootstrap_interval(df, "r", ["i"], replicates=400, seed=1).first()
    two = st.bootstrap_interval(df.repartition(7), "r", ["i"], replicates=400, seed=1).first()
    assert [float(v) for v in one] == pytest.approx([float(v) for v in two])
    se = x.std() / math.sqrt(len(x))
    assert one.mean_low == pytest.approx(x.mean() - 1.96 * se, abs=0.4 * se)
    assert one.mean_high == pytest.approx(x.mean() + 1.96 * se, abs=0.4 * se)
    assert one.std_low < x.std() < one.std_high


def test_folds_partition_the_rows(spark, sf):
    df = legs(spark, sf).select("day", "hhmm")
    n = df.count()
    parts = {(r.cut, r.part): r.n for r in win.rolling_folds(df, ["day", "hhmm"]).groupBy("cut", "part").agg(F.count("*").alias("n")).collect()}
    for cut in (0.2, 0.4, 0.6, 0.8):
        assert parts[(cut, "train")] + parts[(cut, "validation")] == n
        assert parts[(cut, "train")] / n == pytest.approx(cut, abs=0.02)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    label = lambda d: {r.id: r.part for r in sampling.random_split(d, {"a": 0.8, "b": 0.2}, ["id"]).collect()}
    one = label(df)
    assert one == label(df.repartition(13)) and 140 < sum(v == "b" for v in one.values()) < 260


def test_pagerank_matches_power_iteration(spark):
    edges = [(1, "a", "b"), (1, "b", "c"), (1, "c", "a"), (1, "a", "c"), (1, "d", "c"), (1, "d", "c"), (2, "a", "b")]
    df = spark.createDataFrame(edges, "year int, src string, dst string")
    got = {(r.year, r.id): r.pagerank for r in graph.pagerank(df, "year", tolerance=1e-10).collect()}
    names = "abcd"
    pairs = {(s, d) for y, s, d in edges if y == 1}
    rank = np.ones(4)
    for _ in range(200):
        new = np.full(4, 0.15)
        for s, d in pairs:
            new[names.index(d)] += 0.85 * rank[names.index(s)] / sum(1 for a, _ in pairs if a == s)
        rank = new
    rank *= 4 / rank.sum()
    for n, want in zip(names, rank):
        assert got[(1, n)] == pytest.approx(want, rel=1e-6)
    assert got[(2, "a")] + got[(2, "b")] == pytest.approx(2)


def test_lag_falls_back_to_current(spark):
    df = spark.createDataFrame([("x", 2015, 5.0), ("x", 2016, 7.0), ("y", 2016, 1.0)], "id string, year int, m double")
    got = {(r.id, r.year): r.m_lag for r in win.lag_metric(df, "id", "year", ["m"]).collect()}
    assert got == {("x", 2015): 5.0, ("x", 2016): 5.0, ("y", 2016): 1.0}


def test_previous_event_of_one_and_no_aircraft(spark):
    rows = [("t", 1, "A"), ("t", 2, "B"), ("t", 3, "C"), (None, 1, "D"), (None, 2, "E")]
    df = spark.createDataFrame(rows, "tail string, n int, origin string")
    got = {r.origin: r.prev for r in win.previous_event(df, "tail", ["n"], {"prev": "origin"}).collect()}
    assert got == {"A": None, "B": "A", "C": "B", "D": None, "E": None}


def test_draws_split_over_blocks_without_seeing_each_other():
    n, size, reps = 10_000, 1000, 400
    counts = np.array([st.draws_of_block(b, n, reps, 5, size) for b in range(10)])
    assert (counts.sum(axis=0) == n).all() and (counts >= 0).all()
    # ten equal shares of n draws: mean n / 10, variance n * 0.1 * 0.9
    assert abs(counts.mean() - 1000) < 1e-9 and 0.9 < counts.var() / 900 < 1.1
    uneven = np.array([st.draws_of_block(b, 2300, 500, 1, 1000) for b in range(3)])
    assert (uneven.sum(axis=0) == 2300).all() and abs(uneven[2].mean() - 300) < 5
    places = np.concatenate([st.drawn_places(3, r, 1000, 50, 9) for r in range(40)])
    assert places.min() == 0 and places.max() == 49 and np.bincount(places).std() < 60


def test_bootstrap_in_blocks_against_plain_draws(spark, monkeypatch):
    x = np.random.default_rng(2).normal(1e6, 1, 2500)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(9999, None)], "i int, r double").repartition(5)
    got = {r["rep"]: (r["mean"], r["std"]) for r in st._replicate_moments(df, "r", ["i"], 60, 3, 1000).collect()}
    assert len(got) == 60
    for rep in (0, 7, 59):
        drawn = []
        for b in range(3):
            here = x[1000 * b : 1000 * (b + 1)]
            drawn.append(here[st.drawn_places(b, rep, int(st.draws_of_block(b, 2500, 60, 3, 1000)[rep]), len(here), 3)])
        drawn = np.concatenate(drawn)
        assert len(drawn) == 2500 and got[rep] == pytest.approx((drawn.mean(), drawn.std()), rel=1e-9)


def smallest_with_share(values, p):
    from fractions import Fraction

    values = sorted(v for v in values if v is not None)
    return values[max(1, -(-Fraction(str(p)) * len(values) // 1)) - 1] if values else None


@pytest.mark.parametrize("split", [False, True])
def test_discrete_quantiles_match_brute_force(spark, request, split):
    """Ties, nulls, a null key, a group without values, a key with most rows; as one window and in pieces."""
    from millrace.operators.quantiles import attach_quantiles, discrete_quantiles

    if split:
        request.getfixturevalue("small_groups")
    rng = np.random.default_rng(8)
    rows = [(None if k % 7 == 0 else "hot" if k % 3 else f"g{k % 5}", int(rng.integers(200)) if rng.random() < 0.9 else None, float(np.round(rng.normal(), 2))) for k in range(900)]
    rows += [("none", None, 1.5), ("ten", 1, 0.0), *[("ten", v, 0.0) for v in range(2, 11)]]
    df = spark.createDataFrame(rows, "g string, a int, b double")
    wanted = {"a3": ("a", 0.3), "a5": ("a", 0.5), "a0": ("a", 0.0), "b95": ("b", 0.95), "b1": ("b", 1.0)}
    want = {}
    for g in {r[0] for r in rows}:
        want[g] = tuple(smallest_with_share([r["ab".index(c) + 1] for r in rows if r[0] == g], p) for c, p in wanted.values())
    got = discrete_quantiles(df, wanted, ["g"])
    assert got.columns == ["g", *wanted] and {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert want["ten"][0] == 3 and want["none"][0] is None
    (one,) = discrete_quantiles(df, wanted).collect()
    assert tuple(one) == tuple(smallest_with_share([r["ab".index(c) + 1] for r in rows], p) for c, p in wanted.values())
    each = attach_quantiles(df, ["g"], {"m": ("a", 0.5)}).collect()
    assert len(each) == len(rows) and all(r["m"] == want[r["g"]][1] for r in each)
    assert {r["m"] for r in attach_quantiles(df, [], {"m": ("a", 0.5)}).collect()} == {one["a5"]}
    assert discrete_quantiles(df.limit(0), wanted, ["g"]).count() == 0
    assert tuple(discrete_quantiles(df.limit(0), wanted).first()) == (None,) * 5
