"""Trees over groups of equal binned rows are those of Spark ML."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import ml, trees
from millrace.session import GROUP_ROWS_KEY


def _rows(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        x = [float(rng.integers(2)), float(rng.integers(50)), round(rng.normal(), 3), rng.random() * 9, 4.0, float(rng.integers(3))]
        late = float(x[1] / 50 + x[2] + (x[3] > 4) * x[0] + rng.normal() * 0.5 > 1)
        rows.append((k, late, 1.0 + 2 * late, Vectors.sparse(6, [(i, v) for i, v in enumerate(x) if v]) if k % 3 else Vectors.dense(x)))
    return spark.createDataFrame(rows, ["k", "late", "weight", "features"])


# without weights, in small tables and in deep trees nodes have splits of equal gain, between which rounding decides
@pytest.mark.parametrize(
    ("n", "depth", "weight", "near"), [(3000, 5, "weight", 1e-9), (3000, 5, None, 5e-3), (20, 3, "weight", 5e-3), (400, 2, "weight", 1e-9), (3000, 9, None, 5e-3)]
)
def test_same_trees_as_spark_ml(spark, n, depth, weight, near):
    df = _rows(spark, n)
    ours = ml.boosted_trees("late", weight, trees=8, depth=depth, rate=0.2712).fit(df)
    plain = GBTClassifier(labelCol="late", maxIter=8, maxDepth=depth, stepSize=0.2712, seed=42)
    theirs = (plain.setWeightCol(weight) if weight else plain).fit(df)
    assert isinstance(ours, trees.GroupedTreesModel) and len(ours.trees) == 8
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), rtol=0, atol=near)
    new = _rows(spark, 2000, seed=4)
    got = [{r["k"]: r["prediction"] for r in m.transform(new).select("k", "prediction").collect()} for m in (ours, theirs)]
    counts = {(r["late"], r["prediction"]): r["rows"] for r in ours.counted(new, "late").collect()}
    assert counts == {(r["late"], r["prediction"]): r["count"] for r in ours.transform(new).groupBy("late", "prediction").count().collect()}
    assert sum(p != got[1][k] for k, p in got[0].items()) <= (0 if near < 1e-6 else 40) and len(got[0]) == len(got[1]) == 2000


def test_groups_beyond_a_task_go_to_spark_ml(spark):
    df = _rows(spark, 300)
    spark.conf.set(GROUP_ROWS_KEY, "50")
    try:
        assert not isinstance(ml.boosted_trees("late", "weight", trees=2, depth=2).fit(df), trees.GroupedTreesModel)
    finally:
        spark.conf.unset(GROUP_ROWS_KEY)


def test_copies_count_as_weight(spark):
    df = _rows(spark, 500)
    often = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(4))))
    a, b = (ml.boosted_trees("late", "weight", trees=5, depth=4, rate=0.3).fit(d) for d in (df, often))
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray(), atol=1e-9)


def test_bins_of_many_features_take_more_than_one_number():
    rng = np.random.default_rng(1)
    cuts = [np.sort(rng.random(31)) for _ in range(20)]
    layout = trees._layout(cuts)
    assert max(column for column, _, _ in layout) == 1 and all(shift + bits <= 62 for _, shift, bits in layout)


def test_one_outcome(spark):
    df = _rows(spark, 100).withColumn("late", F.lit(1.0))
    model = ml.boosted_trees("late", "weight", trees=3, depth=4).fit(df)
    assert {r["prediction"] for r in model.transform(df).collect()} == {1.0}


def test_validation_scores_groups_as_rows(spark):
    df = _rows(spark, 600)
    grid = {"a": ml.boosted_trees("late", "weight", trees=3, depth=3)}
    plain = GBTClassifier(labelCol="late", weightCol="weight", maxIter=3, maxDepth=3, stepSize=0.1, seed=42)
    got, theirs = (ml.rolling_validation(df, ["k"], "late", {"a": c}, [0.5]).first().asDict() for c in (grid["a"], plain))
    assert got == pytest.approx(theirs)
