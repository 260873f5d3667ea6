"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

Components become integers, and every vector its 64 Walsh-Hadamard coefficients: sums and
differences of integers, so the transform is exact and squared distances in it are 64 times
those of the vectors. Coefficients go from coarse to fine (few sign changes first). A search
adds up squared coefficient differences block by block; the sum so far never falls, so a
centroid whose sum is already above the whole distance of another is strictly worse and
drops out. The others go on to the last of the 64 coefficients. No rounding occurs anywhere.

Vectors are transformed and staged once. In each round every task adds the coefficients of
its vectors by centroid; what comes together in the driver is one sum per centroid and
coefficient, whatever the number of vectors, and the means follow from the sums by the
inverse transform.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stage

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
BLOCKS = (4, 8, 16, 32, DIMENSIONS)
# Larger components are worked on as Python integers, as 64 squared coefficient differences
# of smaller ones always fit in 63 bits.
LARGE = 1 << 24


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row, in its natural order; twice gives 64 times the row."""
    for half in (1 << k for k in range(DIMENSIONS.bit_length() - 1)):
        pairs = rows.reshape(len(rows), DIMENSIONS // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), DIMENSIONS)
    return rows


# Places of the coefficients by their number of sign changes.
ORDER = np.argsort((np.diff(hadamard(np.eye(DIMENSIONS, dtype=np.int64)), axis=1) != 0).sum(axis=1), kind="stable")


def _integers(rows: np.ndarray) -> np.ndarray:
    """floor(256 x) of double components; as Python integers where a row is too large for 64 bits."""
    scaled = np.floor(rows * SCALE)
    if len(scaled) == 0 or np.abs(scaled).max() < LARGE:
        return scaled.astype(np.int64)
    if not np.isfinite(scaled).all():
        raise ValueError("a component times 256 is beyond a double")
    return np.vectorize(int, otypes=[object])(scaled)


def _held(rows: np.ndarray) -> np.ndarray:
    """Plain 64-bit integers if all values allow it, for a fast path with the same results."""
    if rows.dtype == object and (len(rows) == 0 or max(abs(x) for x in rows.flat) < LARGE * DIMENSIONS):
        return rows.astype(np.int64)
    return rows


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of fixed length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), DIMENSIONS)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each point's nearest centre, the smaller number on ties.

    Both are given by coefficients from coarse to fine.
    """
    n, k = len(points), len(centres)
    if n == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if points.dtype == object or centres.dtype == object:
        points, centres = points.astype(object), centres.astype(object)
    everyone = np.arange(n)
    first = BLOCKS[0]
    sums = ((points[:, None, :first] - centres[None, :, :first]) ** 2).sum(axis=2)
    alive = np.ones((n, k), dtype=bool)
    for done, end in zip(BLOCKS, BLOCKS[1:], strict=False):
        leader = np.where(alive, sums, sums.max() + 1).argmin(axis=1)
        whole = sums[everyone, leader] + ((points[:, done:] - centres[leader, done:]) ** 2).sum(axis=1)
        alive &= (sums <= whole[:, None]).astype(bool)
        row, at = np.nonzero(alive)
        sums[row, at] += ((points[row, done:end] - centres[at, done:end]) ** 2).sum(axis=1)
    found = np.where(alive, sums, sums.max() + 1).argmin(axis=1)
    return found, sums[everyone, found] // DIMENSIONS


def _longs(values: np.ndarray) -> pa.Array:
    """Raises if a number doesn't fit in a long."""
    return pa.array([int(x) for x in values], pa.int64()) if values.dtype == object else pa.array(values, pa.int64())


@dataclass
class Clusters:
    """``assigned``: ``vec_id``, ``cluster``, ``distance`` of every kept vector (staged); ``centres``
    and ``counts`` by centroid; ``inertias``, the distance summed over each cluster."""

    assigned: DataFrame
    centres: list[list[int]]
    counts: list[int]
    inertias: list[int]

    def digests(self) -> list[str]:
        """sha256 of each centroid's components, as decimal integers joined by commas."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centres]


def coefficients(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``coefs``, the coefficients from coarse to fine, of every vector that is kept."""
    one = F.col(embedding).cast("array<double>")
    infinite = F.lit(float("inf"))
    sound = F.forall(one, lambda x: x.isNotNull() & (F.abs(x) < infinite))  # NaN is above all numbers
    kept = vectors.select(F.col(id).alias("vec_id"), one.alias("e")).where((F.size("e") == DIMENSIONS) & sound)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coefs = hadamard(_integers(_rows(batch.column("e"))))[:, ORDER]
            lists = pa.FixedSizeListArray.from_arrays(_longs(coefs.reshape(-1)), DIMENSIONS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], names=["vec_id", "coefs"])

    schema = T.StructType([T.StructField("vec_id", kept.schema["vec_id"].dataType), T.StructField("coefs", T.ArrayType(T.LongType()))])
    return kept.mapInArrow(transform, schema)


def _starts(points: DataFrame, k: int) -> list[list[int]]:
    """Coefficients of the ``k`` vectors whose ids have the smallest hashes, in that order."""
    digest = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r["coefs"] for r in points.select(digest.alias("h"), "coefs").orderBy("h", "coefs").limit(k).collect()]


def _sums(points: DataFrame, centres: np.ndarray) -> tuple[dict[int, list[int]], dict[int, int]]:
    """Coefficient sums and counts by nearest centre."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centres), DIMENSIONS), dtype=object), np.zeros(len(centres), dtype=np.int64)
        for batch in batches:
            rows = _held(_rows(batch.column("coefs")))
            cluster, _ = nearest(rows, centres)
            part = np.zeros(sums.shape, dtype=rows.dtype)
            np.add.at(part, cluster, rows)
            sums += part
            counts += np.bincount(cluster, minlength=len(centres))
        some = np.flatnonzero(counts)
        lists = pa.array([[int(x) for x in sums[c]] for c in some], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()), lists], names=["cluster", "n", "sums"])

    parts = points.select("coefs").mapInArrow(add, "cluster int, n long, sums array<long>")
    each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(DIMENSIONS)]
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect()
    return {r["cluster"]: [int(r[f"s{i}"]) for i in range(DIMENSIONS)] for r in found}, {r["cluster"]: r["n"] for r in found}


def _natural(coefs: list[int]) -> list[int]:
    """The integer vector, or sum of vectors, with the given coefficients."""
    row = np.zeros((1, DIMENSIONS), dtype=object)
    row[0, ORDER] = coefs
    return [x // DIMENSIONS for x in hadamard(row)[0]]


def _coefs(centres: list[list[int]]) -> np.ndarray:
    rows = np.array(centres, dtype=object).reshape(len(centres), DIMENSIONS)
    return _held(hadamard(rows)[:, ORDER])


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, id: str = "vec_id", embedding: str = "embedding") -> Clusters:
    """Clusters of the vectors with exactly 64 components, none of them null, NaN or infinite.

    Others are left out. Centroids start as the ``k`` vectors whose ids have the smallest
    hashes, the smaller vector first where ids repeat (a null id counts as empty); with fewer
    vectors there are as many centroids. In each of ``rounds`` rounds all vectors go to their
    nearest centroid (ties: the smaller number), then centroids with vectors become the floor
    of their mean; empty ones stay. At last vectors are assigned once more. Repeated rows count
    each; an empty table has no clusters. Other columns are ignored. Components are taken as
    ``floor(256 x)``, exact at any size; a distance beyond a long raises. Memory per task is a
    batch and ``k`` sums.
    """
    points = stage(coefficients(vectors, id, embedding))
    centres = [_natural(c) for c in _starts(points, k)]
    for _ in range(rounds if centres else 0):
        sums, counts = _sums(points, _coefs(centres))
        centres = [[x // counts[c] for x in _natural(sums[c])] if c in sums else old for c, old in enumerate(centres)]
    at = _coefs(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, distance = nearest(_held(_rows(batch.column("coefs"))), at)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(found, pa.int32()), _longs(distance)], names=["vec_id", "cluster", "distance"])

    schema = T.StructType([points.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = stage(points.mapInArrow(assign, schema))
    totals = {r["cluster"]: r for r in assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    numbers = lambda name: [int(totals[c][name]) if c in totals else 0 for c in range(len(centres))]
    return Clusters(assigned, centres, numbers("n"), numbers("inertia"))


def digest(found: Clusters) -> DataFrame:
    """A row per vector, with its cluster's and the whole inertia and its centroid's digest."""
    spark = found.assigned.sparkSession
    rows = list(zip(range(len(found.centres)), found.inertias, found.digests(), strict=True))
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    joined = found.assigned.join(F.broadcast(clusters), "cluster")  # one row for each centroid
    inertia = F.lit(sum(found.inertias)).cast("long").alias("inertia")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", inertia, "centroid_sha256")
