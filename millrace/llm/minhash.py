"""Near-duplicate documents by MinHash with tensored banding, links confirmed on full sets.

``SIDE`` keys of ``EACH`` minhashes form a collection; two collections are drawn, and every pair
(i-th key of the first, j-th of the second) is a table. So SIDE * SIDE tables of 2 * EACH
minhashes need 2 * EACH * SIDE minhashes instead of 2 * EACH * SIDE * SIDE. A pair of
similarity s is missed if it meets in no key of one collection: at most
2 * (1 - s ** EACH) ** SIDE, 1e-4 at 0.75 and 1e-7 at 0.85. A table's bucket can only hold
two sets if its first half does, so halves that one set has alone are dropped before pairs
of keys are formed.

Links are confirmed on the full shingle sets. Sets that are equal form one class
beforehand. Within a bucket classes are first compared with the smallest class; then classes
beside a bucket's smallest component with those of its members that their sketches are nearest
to. What is then in one component needs no comparison: only classes that share a table and
are still in different components are compared with each other, all of them that two
filters let through. So a group of any number of copies costs a few comparisons per
copy, and no link between components is lost. One filter counts differing bits
among four of each minhash; its bound lies 4.75 standard deviations beyond the mean at
the threshold (1e-6). The other compares sketches of parities: each shingle flips one of
``PARITIES`` bits, so shingles of both sets cancel, and sets never differ in fewer
shingles than their sketches differ in bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textscan
from millrace.llm.components import components
from millrace.session import stage

SHINGLE = 5
EACH = 3
SIDE = 18
PERCENT = 75
PARITIES = 1024
MERGES = 1  # rounds that join components before the rest is compared
TRIES = 3  # comparisons of a class in each of them


def _draws(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Flips and odd factors of ``n`` hash functions of 32 bits."""
    seeds = (textscan.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * textscan.STEP) >> np.uint64(32)).astype(np.uint32)
    return seeds[:n], seeds[n:] | np.uint32(1)


def shingle_sets(column: pa.Array, words_each: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, flat, and the first of each row."""
    words = textscan.scan(column, textscan.SPACED)
    value, _ = textscan.grams(words, words_each)
    sizes = np.diff(words.first)
    for n in range(1, words_each):
        few = words.first[:-1][sizes == n]
        if len(few):
            value[few] = textscan.grams(words, n)[0][few]
    parts = []
    for start, size in zip(words.first.tolist(), sizes.tolist(), strict=False):
        parts.append(np.unique(value[start : start + max(1, size - words_each + 1)]) if size else value[:0])
    first = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)), first


def signatures(flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal sets have equal sums."""
    one = np.concatenate([[np.uint64(0)], np.cumsum(textscan.mix(flat + np.uint64(1)), dtype=np.uint64)])
    two = np.concatenate([[np.uint64(0)], np.cumsum(textscan.mix(flat ^ textscan.STEP), dtype=np.uint64)])
    return np.diff(one[first]), np.diff(two[first])


def minhashes(flat: np.ndarray, first: np.ndarray, many: int) -> np.ndarray:
    """``many`` minhashes of each non-empty set, a row per set."""
    starts = first[:-1][np.diff(first) > 0]
    flips, factors = _draws(many)
    high = (flat >> np.uint64(32)).astype(np.uint32)
    work = np.empty_like(high)
    out = np.empty((many, len(starts)), dtype=np.uint32)
    for k in range(many):
        np.bitwise_xor(high, flips[k], out=work)
        np.multiply(work, factors[k], out=work)
        out[k] = np.minimum.reduceat(work, starts)
    return out.T


def half_keys(low: np.ndarray, each: int) -> np.ndarray:
    """Keys of ``each`` consecutive minhashes; keys at different places never agree."""
    parts = low.reshape(len(low), low.shape[1] // each, each).astype(np.uint64)
    value = np.zeros(parts.shape[:2], dtype=np.uint64)
    for k in range(each):
        value = value * textscan.STEP + parts[:, :, k]
    return textscan.mix(textscan.mix(value) + np.arange(parts.shape[1], dtype=np.uint64))


def bit_sketch(low: np.ndarray) -> np.ndarray:
    """Four bits of each minhash, packed into 64-bit numbers."""
    nibbles = np.zeros((len(low), -(-low.shape[1] // 16) * 16), dtype=np.uint8)
    nibbles[:, : low.shape[1]] = (low >> np.uint32(7)) & np.uint32(15)
    return np.ascontiguousarray(nibbles[:, ::2] << 4 | nibbles[:, 1::2]).view(np.int64)


def parity_sketch(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each of ``PARITIES`` bins, a row per non-empty set."""
    sizes = np.diff(first)
    owner = np.repeat(np.arange(int((sizes > 0).sum())), sizes[sizes > 0])
    place = owner * PARITIES + (flat & np.uint64(PARITIES - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=int((sizes > 0).sum()) * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, PARITIES), axis=1).view(np.int64)


def most_differing(many: int, percent: int) -> int:
    """Differing bits of two sketches that a pair at the threshold has with a chance of 1e-6."""
    apart = 1 - percent / 100
    return math.ceil(2 * apart * many + 4.75 * math.sqrt(many * (5 * apart - 4 * apart * apart)))


def _sketch(each: int, side: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textscan.pieces_of(batch, "text", 1 << 20):
                flat, first = shingle_sets(part.column("text"))
                size = np.diff(first)
                one, two = signatures(flat, first)
                low = minhashes(flat, first, 2 * each * side) if len(flat) else np.zeros((0, 2 * each * side), dtype=np.uint32)
                keys, bits = half_keys(low, each).view(np.int64), bit_sketch(low)

                def rows(values: np.ndarray, size: np.ndarray = size) -> pa.Array:
                    places = np.concatenate([[0], np.cumsum((size > 0) * values.shape[1])])
                    return textscan.lists(values.ravel(), places, pa.int64())

                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(size, pa.int64()),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        rows(keys[:, :side]),
                        rows(keys[:, side:]),
                        rows(bits),
                        rows(parity_sketch(flat, first)),
                    ],
                    names=["row", "doc_id", "text_key", "n_shingles", "one", "two", "a", "b", "bits", "odd"],
                )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textscan.pieces_of(batch, "text"):
            flat, first = shingle_sets(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("class"), textscan.lists(flat.view(np.int64), first, pa.int64())], names=["class", "grams"]
            )


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a`` > ``b``) whose sets are similar enough. ``b`` may be in very many pairs: its
    set is joined to them first, so what is gathered by ``b`` are bare pairs."""
    left = pairs.join(sets.select(F.col("class").alias("b"), F.col("grams").alias("right")), "b")
    both = left.join(sets.select(F.col("class").alias("a"), F.col("grams").alias("left")), "a")
    common = F.size(F.array_intersect("left", "right"))
    return both.where(100 * common >= percent * (F.size("left") + F.size("right") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, each: int = EACH, side: int = SIDE) -> DataFrame:
    """Components of documents whose word-5-gram sets have a Jaccard similarity of ``percent`` % or more.

    ``docs``: ``doc_id``, ``text``; more columns are ignored. Words are lower-cased (A-Z)
    runs between white space. A document of fewer than five words has all of them as its
    one shingle; null, empty and blank texts have none and link with nothing. A row per row
    of ``docs``: ``doc_id``, ``text_key`` (64-bit hash of the text), ``n_shingles``,
    ``component_id`` (smallest ``doc_id`` of the component, its own without links),
    ``kept`` (``doc_id = component_id``; false where ``doc_id`` is null and the
    component has another id). Rows with the same ``doc_id`` stay or go together if
    their texts are alike.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_key", _text_key(F.col("text")))
    rows = stage(
        text.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _sketch(each, side),
            f"row long, doc_id {kind}, text_key long, n_shingles long, one long, two long, a array<long>, b array<long>, bits array<long>, odd array<long>",
        )
    )
    classes = stage(
        rows.where("n_shingles > 0")
        .groupBy("one", "two")
        .agg(
            F.min(F.struct("row", "doc_id", "text_key")).alias("sample"),
            F.min("doc_id").alias("least_id"),
            F.first("n_shingles").alias("n"),
            F.first("a").alias("a"),
            F.first("b").alias("b"),
            F.first("bits").alias("bits"),
            F.first("odd").alias("odd"),
        )
        .withColumn("class", F.col("sample.row"))
    )
    keys = _bucket_keys(classes)
    smallest = F.min(F.struct("class", "n")).alias("least")
    groups = keys.groupBy("key").agg(smallest, F.count("*").alias("m")).where("m > 1").select("key", "least")
    entries = stage(keys.join(groups, "key").select("key", "i", "class", "n", "least"))

    many = 2 * each * side
    sets = _shingles_of(text, classes, entries)
    first = entries.where(F.col("class") > F.col("least.class")).groupBy("class", "n").agg(F.min("least").alias("least"))
    first = first.where(_close(F.col("n"), F.col("least.n"), percent)).select(F.col("class").alias("a"), F.col("least.class").alias("b"))
    links = stage(_verified(first, sets, percent))
    for salt in range(MERGES):
        likely = _likely(_mixed(entries, links), classes, percent, many, salt)
        links = links.union(stage(_verified(likely, sets, percent)))
    rest = _across(_mixed(entries, links), classes, percent, many)
    links = links.union(stage(_verified(rest, sets, percent)))

    named = components(links)
    grouped = classes.select("one", "two", "class", "least_id").join(named, F.col("class") == F.col("id"), "left")
    grouped = grouped.select("one", "two", "least_id", F.coalesce("component", "class").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    final = grouped.join(least, "component").select("one", "two", "component_id")
    out = rows.select("doc_id", "text_key", "n_shingles", "one", "two").join(final, ["one", "two"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _close(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes can be that similar."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _bucket_keys(classes: DataFrame) -> DataFrame:
    """``key``, ``i``, ``class``, ``n``: a row per table and class, where the first half of the key is shared."""
    halves = classes.select("class", F.posexplode("a").alias("i", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("m")).where("m > 1").select("half")
    rows = halves.join(shared, "half").join(classes.select("class", "n", "b"), "class")
    pairs = rows.select("class", "n", "i", "half", F.explode("b").alias("other"))
    return pairs.select(F.xxhash64("half", "other").alias("key"), "i", "class", "n")


def _shingles_of(text: DataFrame, classes: DataFrame, entries: DataFrame) -> DataFrame:
    """Shingle sets of one document of every class that shares a bucket."""
    wanted = classes.join(entries.select("class").distinct(), "class", "left_semi")
    wanted = wanted.select("class", F.col("sample.doc_id").alias("d"), F.col("sample.text_key").alias("t"))
    same = (F.col("text_key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))
    found = text.join(wanted.hint("shuffle_hash"), same).select("class", "text")
    return stage(found.mapInArrow(_sets, "class long, grams array<long>").dropDuplicates(["class"]))


def _mixed(entries: DataFrame, links: DataFrame) -> DataFrame:
    """``key``, ``i``, ``class``, ``component``, ``low``: entries of tables with classes of several
    components, and the smallest of those."""
    named = components(links)
    placed = entries.select("key", "i", "class").join(named, F.col("class") == F.col("id"), "left")
    placed = placed.select("key", "i", "class", F.coalesce("component", "class").alias("component"))
    span = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return stage(placed.join(span.select("key", "low"), "key"))


def _bits_apart(x: str, y: str, words: int) -> Column:
    return sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(words)), F.lit(0))


def _may_link(x: str, y: str, percent: int, many: int) -> Column:
    """Whether sizes and sketches of two classes (column prefixes) allow that similarity."""
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    return (
        _close(nx, ny, percent)
        & (_bits_apart(f"{x}bits", f"{y}bits", -(-many // 16)) <= most_differing(many, percent))
        & (_bits_apart(f"{x}odd", f"{y}odd", PARITIES // 64) * (100 + percent) <= (nx + ny) * (100 - percent))
    )


def _likely(mixed: DataFrame, classes: DataFrame, percent: int, many: int, salt: int) -> DataFrame:
    """For each class beside the smallest component of a bucket, the members of that component
    that its sketch is nearest to. From each bucket one member stands for the component."""
    drawn = F.xxhash64("class", F.lit(salt))
    member = mixed.where("component = low").groupBy("key").agg(F.min_by("class", drawn).alias("rep"))
    beside = mixed.where("component <> low").join(member, "key")
    pairs = beside.groupBy("class", "i").agg(F.min_by("rep", F.xxhash64("rep", F.lit(salt))).alias("rep")).select("class", "rep")
    sketch = classes.select(F.col("class").alias("rep"), F.col("n").alias("r_n"), F.col("bits").alias("r_bits"), F.col("odd").alias("r_odd"))
    near = pairs.join(sketch, "rep").join(classes.select("class", "n", "bits", "odd"), "class").where(_may_link("", "r_", percent, many))
    near = near.withColumn("apart", _bits_apart("odd", "r_odd", PARITIES // 64))
    best = near.groupBy("class").agg(F.slice(F.array_sort(F.collect_set(F.struct("apart", "rep"))), 1, TRIES).alias("best"))
    found = best.select("class", F.explode("best.rep").alias("rep"))
    return found.select(F.greatest("class", "rep").alias("a"), F.least("class", "rep").alias("b"))


def _across(mixed: DataFrame, classes: DataFrame, percent: int, many: int) -> DataFrame:
    """Pairs that share a table and whose classes are still in different components.

    Classes of tables with several components are joined on the first halves of their keys. A
    pair comes from its first common half only, and only if a second half agrees too.
    """
    halves = mixed.select("class", "i", "component").distinct()
    rows = stage(halves.join(classes.select("class", "n", "a", "b", "bits", "odd"), "class").withColumn("half", F.element_at("a", F.col("i") + 1)))
    x, y = rows.alias("x"), rows.alias("y")
    met = (
        (F.col("x.i") == F.col("y.i"))
        & (F.col("x.half") == F.col("y.half"))
        & (F.col("x.class") > F.col("y.class"))
        & (F.col("x.component") != F.col("y.component"))
        & _may_link("x.", "y.", percent, many)
        & (F.element_at(F.array_intersect("x.a", "y.a"), 1) == F.col("x.half"))
        & F.arrays_overlap("x.b", "y.b")
    )
    return x.join(y, met).select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of every component, the one with the smallest ``doc_id``."""
    gone = near_duplicates(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"))
    marked = docs.withColumn("__text_key", _text_key(F.col("text").cast("string")))
    same = (F.col("__text_key") == F.col("__t")) & F.col("doc_id").eqNullSafe(F.col("__d"))
    return marked.join(gone.distinct(), same, "left_anti").select(*docs.columns)
