"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation of the centred vectors is learned on a bounded sample, alternating between binary
codes and the orthogonal map that fits them best, so that bits are balanced and lose
little. The code is cut into chunks; a table for each chunk is probed with the chunk and
all of its one-bit neighbours on both sides, which meets every pair that differs in at most
two bits there. Chunks grow with the logarithm of the rows, and there are as many tables
as it takes for a pair at the threshold to be missed by all with a chance of ``MISS``.
Taking off the mean widens angles where vectors share a common direction, so how many bits
differ at the threshold is measured on pairs of the sample under the learned map.
Pairs whose whole codes are near enough are reranked by the cosine of the original vectors.
Where probing would take more rows than the table has, all pairs of a label are reranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.session import stage

THRESHOLD = 0.93
SAMPLE_ROWS = 20_000  # vectors that rotations are learned on, as drawn by hash
ROUNDS = 40  # of learning
LEAST_CHUNK, MOST_CHUNK = 16, 28  # bits
MISS = 0.01
MISS_BY_DISTANCE = MISS / 10  # of pairs at the threshold, by the bound on the distance of whole codes
TRIAL_BITS = 512  # that differing bits are counted on
TRIAL_PAIRS = 4096  # pairs at the threshold of each kind
TRIAL_ROWS = 8192  # vectors of the sample that are searched for pairs near the threshold
LEAST_PAIRS = 50  # found ones count from so many on
PART_ROWS = 1000  # of a label that a task compares with all others


def _bits_apart(threshold: float) -> float:
    """Chance that a bit differs between vectors at the threshold."""
    return math.acos(min(1.0, max(-1.0, threshold))) / math.pi


def shape(rows: int, threshold: float = THRESHOLD, apart: list[np.ndarray] | None = None) -> tuple[int, int]:
    """Bits of a chunk and number of tables.

    ``apart``: shares of bits that differ in pairs at the threshold, an array for each kind of
    pair; the kind that is hardest to meet decides.
    """
    chunk = min(MOST_CHUNK, max(LEAST_CHUNK, math.ceil(math.log2(max(2, rows)))))
    most = 2
    for p in [np.array([_bits_apart(threshold)]), *(apart or [])]:
        beyond = np.clip(1 - sum(math.comb(chunk, k) * p**k * (1 - p) ** (chunk - k) for k in range(3)), 1e-6, 1.0)
        if (beyond >= 1).mean() > MISS:
            return chunk, 1 << 30
        low, high = 0, 1  # tables that miss more than MISS of the kind, and that don't
        while high < 1 << 30 and (beyond**high).mean() > MISS:
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if (beyond**middle).mean() > MISS else (low, middle)
        most = max(most, high)
    return chunk, most


def reach(bits: int, threshold: float = THRESHOLD, apart: list[np.ndarray] | None = None) -> int:
    """Distance of codes that at most ``MISS_BY_DISTANCE`` of the pairs at the threshold go beyond."""
    k = np.arange(bits + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, bits + 1)))])
    ways = logs[bits] - logs[k] - logs[bits - k]
    most = 0
    for p in [np.array([_bits_apart(threshold)]), *(apart or [])]:
        shares, many = np.unique(np.clip(p, 1e-9, 1 - 1e-9), return_counts=True)
        chance = sum(m * np.exp(ways + k * np.log(x) + (bits - k) * np.log1p(-x)) for x, m in zip(shares, many, strict=True)) / many.sum()
        most = max(most, int(np.argmax(np.cumsum(chance) >= 1 - MISS_BY_DISTANCE)))
    return most


def bits_apart(known: np.ndarray, lengths: np.ndarray, mean: np.ndarray, rotation: np.ndarray, threshold: float, seed: int = 8) -> list[np.ndarray]:
    """Shares of differing bits in pairs at the threshold, by kind of pair.

    A vector of the sample is turned to the threshold: towards another one (so that the pair
    differs as vectors here do) and in any direction; and pairs of the sample with a cosine
    within a tenth of the way from the threshold to 1 are taken as they are.
    """
    if len(known) < 2:
        return []
    rng = np.random.default_rng(seed)
    signs = lambda x: (x - mean) @ rotation >= 0
    at = rng.integers(len(known), size=TRIAL_PAIRS)
    other = (at + rng.integers(1, len(known), size=TRIAL_PAIRS)) % len(known)
    x = known[at]
    own = np.arange(known.shape[1]) < lengths[at][:, None]
    between = known[other] - known[rng.permutation(other)]
    found = []
    for way in (between, rng.standard_normal(x.shape)):
        way = way * own
        way -= np.einsum("ij,ij->i", way, x)[:, None] * x
        size = np.sqrt(np.einsum("ij,ij->i", way, way))
        some = size > 1e-6
        if some.any():
            y = threshold * x[some] + math.sqrt(max(0.0, 1 - threshold**2)) * way[some] / size[some][:, None]
            found.append((signs(x[some]) != signs(y)).mean(axis=1))
    few = known[:TRIAL_ROWS]
    pairs = []
    for start in range(0, len(few), 1024):
        cosine = few[start : start + 1024] @ few.T
        i, j = np.nonzero((cosine >= threshold) & (cosine <= threshold + (1 - threshold) / 10))
        pairs.append(np.stack([i + start, j])[:, i + start < j])
    i, j = np.concatenate(pairs, axis=1)
    if len(i) >= LEAST_PAIRS:
        drawn = rng.permutation(len(i))[:TRIAL_PAIRS]
        found.append((signs(few[i[drawn]]) != signs(few[j[drawn]])).mean(axis=1))
    return found


def plan(known: np.ndarray, lengths: np.ndarray, total: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, int, int, int] | None:
    """Mean, map, bits of a chunk, number of tables and bound on the distance of codes; None if probing takes more than all rows."""
    mean = known.mean(axis=0)
    rotation = learn_rotation(known - mean, TRIAL_BITS, seed=7)
    apart = bits_apart(known, lengths, mean, rotation, threshold)
    chunk, tables = shape(total, threshold, apart)
    if tables * (chunk + 1) >= total:
        return None
    bits = chunk * tables
    if bits > TRIAL_BITS:
        rotation = learn_rotation(known - mean, bits, seed=7)
    return mean, rotation[:, :bits], chunk, tables, reach(bits, threshold, apart)


def learn_rotation(sample: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """A map from centred vectors to ``bits`` numbers whose signs are the code."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1]
    width = max(size, 64)
    if size < width:  # few dimensions are spread over more directions first
        frame = np.linalg.qr(rng.standard_normal((width, size)))[0].T
    else:
        values, vectors = np.linalg.eigh(sample.T @ sample)
        frame = vectors[:, np.argsort(-values)]
    blocks = []
    for start in range(0, bits, 64):
        base = frame[:, : min(64, bits - start)] if size >= width else frame
        mapped = sample @ base
        turn = np.linalg.qr(rng.standard_normal((base.shape[1], base.shape[1])))[0]
        for _ in range(ROUNDS):
            code = np.where(mapped @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(mapped.T @ code, full_matrices=False)
            turn = left @ right
        blocks.append((base @ turn)[:, : bits - start])
    return np.concatenate(blocks, axis=1)[:, :bits]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors of a list column, filled with zeros up to ``size``."""
    first = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(first)
    out = np.zeros((len(column), size))
    owner = np.repeat(np.arange(len(column)), lengths)
    out[owner, np.arange(first[0], first[-1]) - np.repeat(first[:-1], lengths)] = flat[first[0] : first[-1]]
    out /= np.maximum(np.abs(out).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), np.finfo(float).tiny)


def _encode(mean: np.ndarray, rotation: np.ndarray, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.left_shift(np.int64(1), np.arange(chunk, dtype=np.int64))
        for batch in batches:
            signs = (_matrix(batch.column("embedding"), len(mean)) - mean) @ rotation >= 0
            codes = signs.reshape(len(signs), -1, chunk) @ weights
            names = ["class", "label", "dim", *[f"c{t}" for t in range(codes.shape[1])]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("label"), batch.column("dim"), *[pa.array(np.ascontiguousarray(c), pa.int64()) for c in codes.T]], names=names
            )

    return run


def _rerank(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                size = int(np.diff(batch.column("x").offsets.to_numpy()).max())
                x, y = (_matrix(batch.column(c), size) for c in ("x", "y"))
                cosine = np.einsum("ij,ij->i", x, y)
                yield batch.select(["a", "b"]).filter(pa.array(cosine >= threshold))

    return run


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _shuffled(left: DataFrame, right: DataFrame, on: Column | str) -> DataFrame:
    """Both sides shuffled and sorted, whatever size Spark takes them for.

    An exploded table counts as no larger than the file it was read from, and a file of pairs
    unpacks to many times its size: either would be broadcast through the driver's memory.
    """
    return left.hint("merge").join(right.hint("merge"), on)


def _all_pairs(classes: DataFrame, total: int) -> DataFrame:
    """All pairs of a label, each once; the rows of a label are dealt over a task for each ``PART_ROWS``."""
    parts = -(-total // PART_ROWS)
    x = classes.select("class", "label", "dim", F.pmod(F.xxhash64("class"), F.lit(parts)).alias("part")).alias("x")
    y = classes.select("class", "label", "dim", F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("part")).alias("y")
    met = F.lit(True)
    for c in ("label", "dim", "part"):
        met = met & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    return _shuffled(x, y, met & (F.col("x.class") > F.col("y.class"))).select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))


def _candidates(codes: DataFrame, chunk: int, tables: int, most: int) -> DataFrame:
    """Pairs that meet in a table and whose codes are near enough, each once.

    A pair is taken from its first table with at most two differing bits. There it meets at
    its chunk if no bit differs; where the larger class is probed at the flipped bit if one
    does; where the larger class is flipped at the lower bit if two do.
    """
    chunks = [f"c{t}" for t in range(tables)]
    probed = codes.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))).withColumn("f", F.explode(F.sequence(F.lit(-1), F.lit(chunk - 1))))
    own = F.element_at(F.array(*chunks), F.col("t") + 1)
    flipped = F.when(F.col("f") < 0, own).otherwise(own.bitwiseXOR(F.expr("shiftleft(1L, greatest(f, 0))")))
    probed = probed.withColumn("key", flipped + F.expr(f"shiftleft(CAST(t AS BIGINT), {chunk})"))  # one number first to sort by
    x, y = probed.alias("x"), probed.alias("y")
    apart = [F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in chunks]
    earlier = F.lit(True)
    for t, differing in enumerate(apart[:-1]):
        earlier = earlier & ((F.col("x.t") <= t) | (differing > 2))
    fx, fy = F.col("x.f"), F.col("y.f")
    met = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.label") == F.col("y.label"))
        & (F.col("x.dim") == F.col("y.dim"))
        & (F.col("x.class") > F.col("y.class"))
        & ((fy < 0) | ((fx >= 0) & (fx < fy)))
        & (sum(apart[1:], apart[0]) <= most)
        & earlier
    )
    return _shuffled(x, y, met).select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Links between vectors of one label with a cosine of ``threshold`` or more, and their components.

    ``rows``: ``vec_id``, ``embedding`` (array of numbers), ``label``; more columns are ignored. A
    row per row with ``vec_id``, ``n_links`` (other rows linked directly), ``component_id``
    (smallest ``vec_id`` reachable) and ``kept`` (``vec_id = component_id``). Rows with a
    null label, or a vector that is null, empty, zero or has a null or non-finite component,
    link with nothing, nor do vectors of different lengths. Equal vectors of one label are
    one class: they are linked without being compared.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    read = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    given = stage(read.withColumn("row", F.monotonically_increasing_id()))
    good = given.where(F.col("label").isNotNull() & _usable(F.col("embedding")))
    classes = stage(
        good.groupBy("label", "embedding").agg(F.min("row").alias("class"), F.min("vec_id").alias("least_id"), F.count("*").alias("many")).withColumn("dim", F.size("embedding"))
    )
    total, size = classes.agg(F.count("*"), F.max("dim")).first()
    if not total:
        return given.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    share = sample_rows / max(sample_rows, total)
    drawn = F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = classes.where(drawn).select("class", "embedding").toArrow().sort_by("class")
    column = sample.column("embedding").combine_chunks()
    found = plan(_matrix(column, size), np.diff(column.offsets.to_numpy()), total, threshold) if len(column) else None
    if found is None:
        pairs = stage(_all_pairs(classes, total))
    else:
        mean, rotation, chunk, tables, most = found
        codes = classes.select("class", "label", "dim", "embedding").mapInArrow(
            _encode(mean, rotation, chunk), "class long, label string, dim int, " + ", ".join(f"c{t} long" for t in range(tables))
        )
        pairs = stage(_candidates(stage(codes), chunk, tables, most))
    near = _shuffled(pairs, classes.select(F.col("class").alias("b"), F.col("embedding").alias("y")), "b")
    near = _shuffled(near, classes.select(F.col("class").alias("a"), F.col("embedding").alias("x")), "a")
    links = stage(near.select("a", "b", "x", "y").mapInArrow(_rerank(threshold), "a long, b long"))

    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(classes.select(F.col("class").alias("b"), "many"), "b").groupBy("a").agg(F.sum("many").alias("linked"))
    named = components(links)
    whole = classes.select("label", "embedding", "class", "least_id", "many").join(linked, F.col("class") == F.col("a"), "left")
    whole = whole.join(named, F.col("class") == F.col("id"), "left").withColumn("component", F.coalesce("component", "class"))
    least = whole.groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = whole.join(least, "component").select("label", "embedding", "component_id", (F.col("many") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = given.join(found, ["label", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        F.col("vec_id").cast(kind).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
