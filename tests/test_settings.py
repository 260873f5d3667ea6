"""Queries without SQL run with all folds and the settings of the survey."""

import pytest

from millrace.operators import ml
from millrace.operators import trading as replay
from millrace.plans import learning
from millrace.plans import trading as plan


class Fitted(Exception):
    pass


@pytest.fixture
def small(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    rows = [(k, 0, "train", float(k % 2), 1.0, Vectors.dense(float(k), 1.0)) for k in range(10)]
    df = spark.createDataFrame(rows, ["day", "hhmm", "split", "late", "weight", "features"])
    monkeypatch.setattr(learning, "_ready", lambda *_: (df, None))


def stop(into):
    def fit(est, *_):
        into.append(est)
        raise Fitted

    return fit


def test_all_folds_and_trees(small, monkeypatch):
    seen = {}

    def validate(df, order, label, candidates, cuts=ml.FOLD_CUTS):
        seen.update(cuts=cuts, candidates=list(candidates.values()))
        raise Fitted

    monkeypatch.setattr(ml, "rolling_validation", validate)
    with pytest.raises(Fitted):
        learning.best_tree_parameters(None, "")
    assert seen["cuts"] == ml.FOLD_CUTS == (0.2, 0.4, 0.6, 0.8)
    assert {c.getMaxIter() for c in seen["candidates"]} == {115}
    assert (9, 0.2712) in {(c.getMaxDepth(), c.getStepSize()) for c in seen["candidates"]}


def test_trees_and_layers(small, monkeypatch):
    fitted = []
    for kind in (ml.GBTClassifier, ml.MultilayerPerceptronClassifier):
        monkeypatch.setattr(kind, "fit", stop(fitted))
    for query in (learning.tree_importance, learning.perceptron_metrics):
        with pytest.raises(Fitted):
            query(None, "")
    trees, net = fitted
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize()) == (115, 9, 0.2712)
    assert (net.getLayers(), net.getMaxIter()) == ([2, 448, 2], 100)


def test_both_replay_settings(spark, monkeypatch):
    monkeypatch.setattr(plan, "bars", lambda *_: None)
    asked = []

    def replayed(bars, symbol, time, window, age):
        asked.append((window, age))
        return spark.createDataFrame([("a", 5, window)], "symbol string, seen_at int, buy_time int")

    monkeypatch.setattr(replay, "replay_windows", replayed)
    got = plan.replayed_buy_points(spark, "").collect()
    assert asked == [(147, 21), (504, 72)] and sorted(r["window"] for r in got) == [147, 504]
