"""Boosted trees of Spark ML over groups of equal binned rows.

A tree tells rows apart by their bins only, and rows of equal bins and label have the same
residual in every round. They count as one row of their summed weight: the trees are those
of ``GBTClassifier``, and a fit takes the time of the groups, however many rows there are. Thresholds are
found as Spark ML finds them. One task grows the trees of a fit, without a job for each level; if there are
more groups than a task may hold, Spark ML fits them. Between splits of equal gain rounding decides, as it does there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import max_group_rows, stage

SPLIT_ROWS = 10_000  # rows, at least, that Spark ML looks for thresholds in
CODE_BITS = 62  # of bins that are packed into one number
JOINT_BINS = 64  # features of few bins share a histogram of up to this many
EPSILON = 2.0**-52  # a child of less variance is a leaf


def thresholds(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` thresholds of a feature, between weighted quantiles, as Spark ML has them."""
    found, at = np.unique(values, return_inverse=True)
    each = np.bincount(at.ravel(), weights, len(found))
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= most:
        return between
    stride = each.sum() / (most + 1)
    total, target, out = each[0], stride, []
    for k in range(1, len(found)):
        before, total = total, total + each[k]
        if abs(before - target) < abs(total - target):
            out.append(between[k - 1])
            target += stride
    return np.array(out)


def _layout(cuts: Sequence[np.ndarray]) -> list[tuple[int, int, int]]:
    """Number, shift and bits of every feature's bin among the packed numbers."""
    out, column, used = [], 0, 0
    for c in cuts:
        bits = len(c).bit_length()
        if used + bits > CODE_BITS:
            column, used = column + 1, 0
        out.append((column, used, bits))
        used += bits
    return out


def _bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> list[np.ndarray]:
    return [np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)]


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _unpack(held: pa.Table | pa.RecordBatch, cuts: Sequence[np.ndarray]) -> np.ndarray:
    bins = np.empty((len(cuts), held.num_rows), np.uint8 if max(len(c) for c in cuts) < 256 else np.int32)
    for k, (column, shift, bits) in enumerate(_layout(cuts)):
        bins[k] = (held.column(f"c{column}").to_numpy() >> shift) & ((1 << bits) - 1)
    return bins


def _grouped(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Packed bins and label of ``rows`` (``features``, ``label``, ``weight``) with their summed weight, once each."""
    names = [f"c{k}" for k in range(_layout(cuts)[-1][0] + 1)]
    schema = ", ".join(f"{c} long" for c in names) + ", label double, weight double"
    packed = rows.select(vector_to_array("features").alias("x"), "label", "weight").mapInArrow(_pack(cuts), schema)
    return packed.groupBy(*names, "label").agg(F.sum("weight").alias("weight"))


def _pack(cuts: list[np.ndarray]):
    layout = _layout(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((layout[-1][0] + 1, batch.num_rows), np.int64)
            for (column, shift, _), b in zip(layout, _bins(_vectors(batch.column("x"), len(cuts)), cuts), strict=True):
                codes[column] |= b.astype(np.int64) << shift
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c) for c in codes], batch.column("label"), batch.column("weight")], names=[*[f"c{k}" for k in range(len(codes))], "label", "weight"]
            )

    return run


def _joint(widths: Sequence[int]) -> list[list[int]]:
    """Features by histogram: those of few bins share one."""
    blocks, open_block, size = [], [], 1
    for f in np.argsort(widths, kind="stable"):
        if open_block and size * widths[f] > JOINT_BINS:
            blocks.append(open_block)
            open_block, size = [], 1
        open_block, size = [*open_block, int(f)], size * widths[f]
    return [*blocks, open_block]


def _variance(weight: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    return (squares - total * total / weight) / weight


class _Grower:
    """Trees over binned rows ``bins`` (a row of numbers per feature) of weights ``w``."""

    def __init__(self, bins: np.ndarray, w: np.ndarray, widths: Sequence[int], depth: int):
        self.bins, self.w, self.widths, self.depth = bins, w, widths, depth
        self.blocks = []
        for block in _joint(widths):
            code = np.zeros(bins.shape[1], np.int64)
            for f in block:
                code = code * widths[f] + bins[f]
            self.blocks.append((block, [widths[f] for f in block], code))

    def _best(self, node, rows, values, impurity):
        """Gain, feature, bin and left-hand sums of every node's best split; a gain of -inf where there is none.

        Worked out in the steps of Spark ML, as rounding decides between equal gains.
        """
        k, n_features = len(impurity), len(self.widths)
        gains, places = np.full((n_features, k), -np.inf), np.zeros((n_features, k), np.int64)
        lefts = np.zeros((n_features, 3, k))
        for block, sizes, code in self.blocks:
            cells = int(np.prod(sizes))
            key = node * cells
            key += code if rows is None else code[rows]
            held = [np.bincount(key, v, k * cells).reshape(k, *sizes) for v in values]
            for at, f in enumerate(block):
                if sizes[at] < 2:
                    continue
                others = tuple(a + 1 for a in range(len(sizes)) if a != at)
                sums = [h.sum(axis=others) for h in held]
                some = (np.cumsum(sums[0], 1)[:, :-1] > 0) & (np.cumsum(sums[0][:, ::-1], 1)[:, ::-1][:, 1:] > 0)
                upto = [np.cumsum(h, 1) for h in sums]
                left = [u[:, :-1] for u in upto]
                right = [u[:, -1:] - u[:, :-1] for u in upto]
                with np.errstate(divide="ignore", invalid="ignore"):
                    total = left[0] + right[0]
                    gain = impurity[:, None] - left[0] / total * _variance(*left) - right[0] / total * _variance(*right)
                gain = np.where(some & (gain >= 0), gain, -np.inf)
                places[f] = np.argmax(gain, 1)
                gains[f] = gain[np.arange(k), places[f]]
                lefts[f] = [v[np.arange(k), places[f]] for v in left]
        feature, node = np.argmax(gains, 0), np.arange(k)
        return gains[feature, node], feature, places[feature, node], lefts[feature, :, node].T

    def grow(self, r: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """A tree fitted to ``r``, what it predicts for each row, and the gain of each feature times the weight it splits."""
        n, wr = len(r), self.w * r
        values = [self.w, wr, wr * r]
        out, importance = np.empty(n), np.zeros(len(self.widths))
        feature, place, left, value = [-1], [0], [0], [0.0]
        names = np.zeros(1, np.int64)  # of the nodes of this level
        sums = np.array([[v.sum()] for v in values])
        rows, node = None, np.zeros(n, np.int64)
        for level in range(self.depth + 1):
            mean, variance = sums[1] / sums[0], _variance(*sums)
            for name, v in zip(names, mean, strict=True):
                value[name] = v
            splits = np.abs(variance) >= EPSILON
            if level < self.depth and splits.any():
                gain, best, at, lefts = self._best(node, rows, values, variance)
                splits &= gain > 0
            else:
                splits[:] = False
            child = np.full(len(names), -1, np.int64)
            child[splits] = 2 * np.arange(splits.sum())
            for s in np.flatnonzero(splits):
                name = names[s]
                feature[name], place[name], left[name] = int(best[s]), int(at[s]), len(feature)
                feature += [-1, -1]
                place += [0, 0]
                left += [0, 0]
                value += [0.0, 0.0]
                importance[best[s]] += gain[s] * sums[0][s]
            if not splits.all():
                stays = splits[node]
                gone = ~stays
                out[gone if rows is None else rows[gone]] = mean[node[gone]]
                rows = np.flatnonzero(stays) if rows is None else rows[stays]
                node, values = node[stays], [v[stays] for v in values]
            if not len(node):
                break
            seen = self.bins[best[node], np.arange(n) if rows is None else rows]
            node = child[node] + (seen > at[node])
            names = np.array([left[s] + side for s in names[splits] for side in (0, 1)])
            sums = np.stack([lefts[:, splits], sums[:, splits] - lefts[:, splits]], axis=2).reshape(3, -1)
        return {"feature": np.array(feature), "place": np.array(place), "left": np.array(left), "value": np.array(value), "depth": level}, out, importance


def boost(bins: np.ndarray, y: np.ndarray, w: np.ndarray, widths: Sequence[int], trees: int, depth: int, rate: float) -> tuple[list[dict[str, np.ndarray]], np.ndarray]:
    """Trees that follow each other's log loss on outcomes of -1 and 1, and the importance of features, not normalised."""
    grower = _Grower(bins, w, widths, depth)
    reached, grown, importance = np.zeros(len(y)), [], np.zeros(len(widths))
    for t in range(trees):
        tree, predicted, gains = grower.grow(4 * y / (1 + np.exp(2 * y * reached)) if t else y)
        grown.append(tree)
        importance += gains
        reached += (rate if t else 1.0) * predicted
    return grown, importance


def _fit_groups(cuts: list[np.ndarray], trees: int, depth: int, rate: float):
    widths = [len(c) + 1 for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches))
        if not held.num_rows:
            return
        bins = _unpack(held, cuts)
        y, w = 2.0 * held.column("label").to_numpy() - 1, held.column("weight").to_numpy()
        grown, importance = boost(bins, y, w, widths, trees, depth, rate)
        depths = pa.array([t["depth"] for t in grown], pa.int32())
        arrays = [pa.array([t[name].tolist() for t in grown], pa.list_(kind)) for name, kind in (("feature", pa.int32()), ("place", pa.int32()), ("left", pa.int32()), ("value", pa.float64()))]
        yield pa.RecordBatch.from_arrays([*arrays, depths, pa.array([importance.tolist()] * len(grown))], names=["feature", "place", "left", "value", "depth", "importance"])

    return run


def _margin(bins: np.ndarray, trees: list[dict[str, np.ndarray]], rate: float) -> np.ndarray:
    """Sum of what the trees predict for rows of ``bins`` (a row of numbers per feature)."""
    size, n = bins.shape
    flat, row = np.ascontiguousarray(bins.T).ravel(), np.arange(n) * size
    total = np.zeros(n)
    for k, t in enumerate(trees):
        leaf = t["feature"] < 0  # stays where it is, as no bin is beyond its place
        feature, place = np.where(leaf, 0, t["feature"]).astype(np.int64), np.where(leaf, np.iinfo(np.int32).max, t["place"])
        left, node = np.where(leaf, np.arange(len(leaf)), t["left"]).astype(np.int64), np.zeros(n, np.int64)
        for _ in range(t["depth"]):
            node = left[node] + (flat[row + feature[node]] > place[node])
        total += (rate if k else 1.0) * t["value"][node]
    return total


class GroupedTreesModel(Model):
    """Boosted trees with the prediction and the feature importances of Spark ML's model."""

    def __init__(self, cuts: list[np.ndarray], trees: list[dict[str, np.ndarray]], rate: float, importance: np.ndarray, features: str, prediction: str):
        super().__init__()
        self.cuts, self.trees, self.rate, self.features, self.prediction = cuts, trees, rate, features, prediction
        total = importance.sum()
        self.featureImportances: DenseVector = Vectors.dense(importance / total if total > 0 else importance)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts, trees, rate = self.cuts, self.trees, self.rate

        @F.arrow_udf("double")
        def predict(x: pa.Array) -> pa.Array:
            bins = np.stack(_bins(_vectors(x, len(cuts)), cuts)).astype(np.int32)
            return pa.array((_margin(bins, trees, rate) > 0).astype(np.float64))

        return dataset.withColumn(self.prediction, predict(vector_to_array(self.features)))

    def counted(self, dataset: DataFrame, label: str) -> DataFrame:
        """Rows (``rows``) by ``label`` and prediction, predicted once for each group of equal bins."""
        cuts, trees, rate = self.cuts, self.trees, self.rate

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                late = (_margin(_unpack(batch, cuts).astype(np.int32), trees, rate) > 0).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(late), batch.column("weight")], names=[label, self_prediction, "rows"])

        self_prediction = self.prediction
        rows = dataset.select(F.col(self.features).alias("features"), F.col(label).cast("double").alias("label"), F.lit(1.0).alias("weight"))
        done = _grouped(rows, cuts).mapInArrow(predict, f"`{label}` double, `{self_prediction}` double, rows double")
        return done.groupBy(label, self_prediction).agg(F.sum("rows").cast("long").alias("rows"))


class GroupedTrees(GBTClassifier):
    """``GBTClassifier`` that fits groups of equal binned rows, if a task can hold them."""

    def _plain(self, dataset: DataFrame) -> bool:
        """Whether only settings that ``boost`` knows are in use."""
        nominal = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal")
        return not nominal and not self.isDefined("validationIndicatorCol") and not self.isDefined("thresholds") and (
            self.getSubsamplingRate(), self.getFeatureSubsetStrategy(), self.getMinInstancesPerNode(), self.getMinInfoGain(), self.getMinWeightFractionPerNode()
        ) == (1.0, "all", 1, 0.0, 0.0)

    def _fit(self, dataset: DataFrame):
        if not self._plain(dataset):
            return super()._fit(dataset)
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined("weightCol") and self.getWeightCol() else F.lit(1.0)
        rows = dataset.select(F.col(self.getFeaturesCol()).alias("features"), F.col(self.getLabelCol()).cast("double").alias("label"), weight.alias("weight"))
        total, good = rows.agg(F.count("*"), F.count_if(F.col("label").isin(0.0, 1.0) & (F.col("weight") > 0) & F.col("features").isNotNull())).first()
        if not total or good < total:
            return super()._fit(dataset)  # its errors, and its reading of weights of 0
        most = min(self.getMaxBins(), total)
        wanted = max(most * most, SPLIT_ROWS)
        seen = (rows if wanted >= total else rows.sample(False, wanted / total, self.getSeed())).select(vector_to_array("features").alias("x"), "weight").toArrow()
        if not len(seen):
            return super()._fit(dataset)
        size = len(seen.column("x")[0])
        x, w = _vectors(seen.column("x").combine_chunks(), size), seen.column("weight").to_numpy()
        if np.isnan(x).any():
            return super()._fit(dataset)
        cuts = [thresholds(x[:, f], w, most - 1) for f in range(size)]
        groups = stage(_grouped(rows, cuts))
        if groups.count() > max_group_rows(dataset.sparkSession):
            return super()._fit(dataset)
        fitted = groups.repartition(1).mapInArrow(
            _fit_groups(cuts, self.getMaxIter(), self.getMaxDepth(), self.getStepSize()),
            "feature array<int>, place array<int>, left array<int>, value array<double>, depth int, importance array<double>",
        ).toArrow()
        trees = [{c: np.array(v[c]) for c in ("feature", "place", "left", "value")} | {"depth": v["depth"]} for v in fitted.to_pylist()]
        importance = np.array(fitted.column("importance")[0].as_py())
        return GroupedTreesModel(cuts, trees, self.getStepSize(), importance, self.getFeaturesCol(), self.getPredictionCol())
