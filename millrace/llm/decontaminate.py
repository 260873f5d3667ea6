"""Benchmark decontamination by winnowing.

Both sides keep, of every six consecutive 5-word hashes, the smallest (the
rightmost among equals). Two texts that share ten consecutive words share a
window of six such hashes and so a kept one, at the same place in the span.
Distinct fingerprints are joined on their hash, which gives the pairs of
document and item that share one. Around each kept fingerprint of a document,
the windows of ten words that contain it are looked up among the windows of its
items and compared word by word; hits that follow one another extend a span.
Items of fewer than ten words have no such window: all of their words form one
fingerprint, and documents are searched for runs of exactly those lengths.

A passage that repeats, within a text or over texts, costs its length and not the
number of ways in which its repeats can be aligned: fingerprints are joined once per
document and item, and windows are looked up, not paired.

Documents keep a fingerprint only if a Bloom filter of the items' fingerprints
(of a fixed size, whatever the input) admits it, so what is shuffled are the
documents with a likely hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textscan
from millrace.session import stage

WINDOW = 10  # words that make a hit
GRAM = 5  # words of a fingerprint
PART_WORDS = 1_000_000  # of items that a document is compared with at once
FILTER_BITS = 24  # the Bloom filter has 2 ** 24 bits, 2 MB


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return hashes & mask, (hashes >> np.uint64(FILTER_BITS)) & mask


def winnow(words: textscan.Words) -> np.ndarray:
    """Places of the words at which kept fingerprints start."""
    value, _ = textscan.grams(words, GRAM)
    span = WINDOW - GRAM + 1
    count = len(value)
    if count < WINDOW:
        return np.zeros(0, dtype=np.int64)
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(count)
    start = np.flatnonzero(left >= WINDOW)
    best, place = value[start], start.copy()
    for j in range(1, span):
        other = value[start + j]
        lower = other <= best
        best[lower] = other[lower]
        place[lower] = start[lower] + j
    return np.unique(place)


def _rows(words: textscan.Words, chosen: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places within the document, hashes, and the first of each document."""
    place = np.concatenate([p for p, _ in chosen])
    value = np.concatenate([v for _, v in chosen])
    order = np.argsort(place, kind="stable")
    place, value = place[order], value[order]
    first = np.searchsorted(place, words.first)
    owner = np.searchsorted(words.first, place, side="right") - 1
    return place - words.first[owner], value, first


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textscan.pieces_of(batch, "text"):
            words = textscan.scan(part.column("text"), textscan.ALNUM)
            value, _ = textscan.grams(words, GRAM)
            places = winnow(words)
            chosen = [(places, value[places])]
            sizes = np.diff(words.first)
            for n in range(1, WINDOW):
                whole = words.first[:-1][sizes == n]
                if len(whole):
                    chosen.append((whole, textscan.grams(words, n)[0][whole]))
            place, hashes, first = _rows(words, chosen)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("item"),
                    part.column("item_id").cast(pa.string()),
                    pa.array(sizes, type=pa.int64()),
                    textscan.lists(words.hash.view(np.int64), words.first, pa.int64()),
                    textscan.lists(place, first, pa.int32()),
                    textscan.lists(hashes.view(np.int64), first, pa.int64()),
                ],
                names=["item", "item_id", "n", "item_words", "places", "hashes"],
            )


def _doc_prints(filled: np.ndarray, short: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.unpackbits(filled, bitorder="little").view(bool)
        for batch in batches:
            for part in textscan.pieces_of(batch, "text"):
                words = textscan.scan(part.column("text"), textscan.ALNUM)
                chosen = []
                for n in [0, *short]:
                    value, whole = textscan.grams(words, n or GRAM)
                    places = np.flatnonzero(whole) if n else winnow(words)
                    one, two = _bits(value[places])
                    places = places[flat[one] & flat[two]]
                    chosen.append((places, value[places]))
                place, hashes, first = _rows(words, chosen)
                hit = np.diff(first) > 0
                kept = np.repeat(hit, np.diff(words.first))
                starts = np.concatenate([[0], np.cumsum(np.where(hit, np.diff(words.first), 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        pa.array(np.diff(words.first), type=pa.int64()),
                        textscan.lists(words.hash.view(np.int64)[kept], starts, pa.int64()),
                        textscan.lists(place, first, pa.int32()),
                        textscan.lists(hashes.view(np.int64), first, pa.int64()),
                    ],
                    names=["row", "doc_id", "n_words", "words", "places", "hashes"],
                )

    return run


def _hits(own: np.ndarray, places: np.ndarray, others: textscan.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``n`` words near ``places`` occur in the others that have them, and which these are."""
    sizes = np.diff(others.first)
    back = WINDOW - GRAM if n == WINDOW else 0
    start = np.unique(places[:, None] - np.arange(back + 1))
    start = start[(start >= 0) & (start <= len(own) - n)]
    window = textscan.grams(textscan.Words(own, np.array([0, len(own)]), {}), n)[0][start]
    value, whole = textscan.grams(others, n)
    at = np.flatnonzero(whole & np.repeat(sizes >= n if n == WINDOW else sizes == n, sizes))
    at = at[np.argsort(value[at], kind="stable")]
    if not len(at) or not len(start):
        return start[:0], at[:0]
    near = np.minimum(np.searchsorted(value[at], window), len(at) - 1)
    same = value[at][near] == window
    start, window, there = start[same], window[same], at[near[same]]
    equal = np.ones(len(start), dtype=bool)
    for j in range(n):
        equal &= own[start + j] == others.hash[there + j]
    return start[equal], np.unique(others.owner()[at[np.isin(value[at], window[equal])]])


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each document whose windows occur in items that share a fingerprint, and these items."""
    for batch in batches:
        rows, spans, items = [], [], []
        for i in range(batch.num_rows):
            own = batch.column("words")[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            places = batch.column("places")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            matches = batch.column("matches")[i].values
            listed = matches.field("item_words")
            sizes = listed.value_lengths().to_numpy(zero_copy_only=False)
            others = textscan.Words(
                listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), {}
            )
            ranges: set[tuple[int, int]] = set()
            named: set[int] = set()
            for n in np.unique(np.minimum(sizes, WINDOW)).tolist():
                start, which = _hits(own, places, others, n)
                if len(start):
                    gap = np.flatnonzero(np.diff(start) > 1)
                    first, last = start[np.concatenate([[0], gap + 1])], start[np.concatenate([gap, [len(start) - 1]])]
                    ranges.update(zip(first.tolist(), (last + n).tolist(), strict=True))
                    named.update(which.tolist())
            if ranges:
                rows.append(batch.column("row")[i].as_py())
                spans.append([{"start": s, "stop": e} for s, e in sorted(ranges)])
                ids = matches.field("item_id").take(pa.array(sorted(named), pa.int64())).to_pylist()
                items.append(sorted({x for x in ids if x is not None}))
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
            names=["row", "spans", "items"],
        )


def _item_filter(prints: DataFrame) -> np.ndarray:
    """Bloom filter of all item fingerprints; the driver gets at most 2 ** 18 rows."""
    mask = (1 << FILTER_BITS) - 1
    hashes = prints.select(F.explode("hashes").alias("h"))
    bit = F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", FILTER_BITS).bitwiseAND(mask)))
    filled = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    words = (
        hashes.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("slot"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits"))
    )
    for slot, bits in words.collect():
        filled[slot] = bits
    return filled.view(np.uint8)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Words of each document that lie in a passage of a benchmark item.

    ``docs``: ``doc_id``, ``text``; ``items``: ``item_id``, ``text``; more columns are
    ignored. A row per row of ``docs`` (repeated rows stay apart) with ``doc_id``,
    ``n_words``, ``n_hit``, ``items`` (distinct ids as strings, sorted) and ``spans``
    (word ranges, end exclusive, sorted; they may overlap). Null and empty texts have no
    words; without items nothing is hit. An item with a null id hits words but is not listed.
    """
    named = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    prints = stage(
        named.mapInArrow(_item_prints, "item long, item_id string, n long, item_words array<long>, places array<int>, hashes array<long>")
    )
    short = sorted(r[0] for r in prints.where((F.col("n") > 0) & (F.col("n") < WINDOW)).select("n").distinct().collect())
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = stage(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
            _doc_prints(_item_filter(prints), short),
            f"row long, doc_id {kind}, n_words long, words array<long>, places array<int>, hashes array<long>",
        )
    )

    shared = (
        found.select("row", F.explode(F.array_distinct("hashes")).alias("hash"))
        .join(prints.select("item", "n", F.explode(F.array_distinct("hashes")).alias("hash")), "hash")
        .groupBy("row", "item")
        .agg(F.first("n").alias("n"))
    )
    # A document with very many items is compared with some of them at a time.
    parts = F.ceil(F.sum("n").over(Window.partitionBy("row")) / PART_WORDS)
    matches = (
        shared.select("row", "item", F.pmod(F.xxhash64("item"), parts).alias("part"))
        .join(prints.select("item", "item_id", "item_words"), "item")
        .groupBy("row", "part")
        .agg(F.collect_list(F.struct("item_id", "item_words")).alias("matches"))
    )
    each = (
        found.where(F.size("hashes") > 0)
        .select("row", "words", "places")
        .join(matches, "row")
        .select("row", "words", "places", "matches")
        .mapInArrow(_extend, "row long, spans array<struct<start:long,stop:long>>, items array<string>")
    )
    whole = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    hits = each.groupBy("row").agg(whole("spans"), whole("items"))
    none = F.array().cast("array<string>")
    return (
        found.select("row", "doc_id", "n_words")
        .join(hits, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce(_covered("spans"), F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start:long,stop:long>>")).alias("spans"),
        )
    )


def _covered(spans: str) -> Column:
    """Words in the union of sorted ranges."""
    return F.expr(
        f"aggregate({spans}, named_struct('n', 0L, 'end', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s.stop - greatest(a.end, s.start)), 'end', greatest(a.end, s.stop)), a -> a.n)"
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: counts, and a digest of the listed items."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage, judged by text alone."""
    hashed = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    marked = docs.withColumn("__text_key", hashed)
    texts = marked.select(F.col("__text_key").alias("doc_id"), "text")
    bad = decontaminate(texts, items).where("n_hit > 0").select(F.col("doc_id").alias("__text_key")).distinct()
    return marked.join(bad, "__text_key", "left_anti").select(*docs.columns)

