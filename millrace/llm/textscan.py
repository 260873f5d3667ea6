"""Words of whole Arrow batches as 64-bit numbers, without a Python loop over words.

A batch's texts lie in one buffer of UTF-8 bytes. Words are runs of bytes that a
256-entry table marks; their hashes are differences of a running polynomial over
the buffer, so the work is a few numpy passes over the bytes. Buffers are worked
on in pieces of ``PIECE`` bytes that end between words, so memory per byte of a
very long text stays small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PIECE = 1 << 21
# Fixed odd numbers of the hash functions.
BASE = 0x9E3779B97F4A7C15
STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_table(*excluded: tuple[int, int]) -> np.ndarray:
    """True for every byte outside the given closed ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in excluded:
        table[low : high + 1] = False
    return table


# Words are what lies between spaces, tabs and line ends.
SPACED = byte_table((0x20, 0x20), (0x09, 0x0D))
# Words are runs of ASCII digits, a-z and everything beyond ASCII.
ALNUM = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: list[np.ndarray] = []


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the polynomial's base and of its inverse; those of a usual piece are kept."""
    if _POWERS and size <= PIECE:
        return _POWERS
    tables = [np.full(max(size, PIECE) + 1, x, dtype=np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64))]
    for x in tables:
        x[0] = 1
        np.cumprod(x, out=x)
    if size <= PIECE:
        _POWERS.extend(tables)
    return tables


@dataclass
class Words:
    """Word hashes of a batch; document ``i`` has words ``first[i]:first[i + 1]``."""

    hash: np.ndarray
    first: np.ndarray
    prefix: dict[int, np.ndarray]

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most ``rows`` rows.

    Spark's usual ten thousand take hundreds of MB on both sides when rows are whole texts.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the place of each row in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or places[-1] == places[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[places[0] : places[-1]], places - places[0]


def edges(inside: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at ``breaks``."""
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    starts = inside & ~before
    at = breaks[breaks < len(inside)]
    starts[at] = inside[at]
    first = np.flatnonzero(starts)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    ends = inside & ~after
    at = breaks[(breaks > 0) & (breaks <= len(inside))] - 1
    ends[at] = inside[at]
    return first, np.flatnonzero(ends) + 1


def _cut(data: np.ndarray, places: np.ndarray, table: np.ndarray, at: int) -> int:
    """Where the piece that starts at ``at`` ends: never within a word."""
    end = at + PIECE
    if end >= len(data):
        return len(data)
    row = int(places[np.searchsorted(places, end, side="right") - 1])
    outside = np.flatnonzero(~table[LOWER[data[end - 4096 : end]]])
    back = max(row, end - 4096 + int(outside[-1]) + 1 if len(outside) else 0)
    if back > at:
        return back
    while end < len(data) and end not in places and table[LOWER[data[end]]]:  # a word longer than a piece
        ahead = np.flatnonzero(~table[LOWER[data[end : end + PIECE]]])
        stop = end + int(ahead[0]) if len(ahead) else min(end + PIECE, len(data))
        end = min(stop, int(places[np.searchsorted(places, end, side="right")]))
    return end


def cuts(data: np.ndarray, places: np.ndarray, table: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of a buffer of bytes that end between words."""
    at = 0
    while at < len(data):
        end = _cut(data, places, table, at)
        yield at, end
        at = end


def scan(column: pa.Array, table: np.ndarray = SPACED, prefixes: tuple[int, ...] = ()) -> Words:
    """Hashes of all words of all rows, A-Z taken as a-z.

    ``prefixes``: also hashes of each word's first so many bytes (0 if it is not longer).
    """
    data, places = utf8(column)
    hashes: list[np.ndarray] = []
    begins: list[np.ndarray] = []
    shorter: dict[int, list[np.ndarray]] = {n: [] for n in prefixes}
    for at, end in cuts(data, places, table):
        piece = LOWER[data[at:end]]
        low, high = np.searchsorted(places, [at, end])
        start, stop = edges(table[piece], places[low:high] - at)
        power, inverse = _powers(len(piece))
        running = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)], out=running[1:])
        hashes.append(mix((running[stop] - running[start]) * inverse[start]))
        begins.append(start + at)
        for n in prefixes:
            cut = np.minimum(start + n, len(piece))
            some = mix((running[cut] - running[start]) * inverse[start] + np.uint64(n))
            some[start + n >= stop] = 0
            shorter[n].append(some)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    begin = join(begins, np.int64)
    return Words(
        join(hashes, np.uint64),
        np.searchsorted(begin, places),
        {n: join(parts, np.uint64) for n, parts in shorter.items()},
    )


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``n`` consecutive words of a document, and whether a run starts there."""
    count = len(words.hash)
    out = np.zeros(count, dtype=np.uint64)
    whole = np.zeros(count, dtype=bool)
    if count >= n:
        value = words.hash[: count - n + 1].copy()
        for j in range(1, n):
            value *= STEP
            value += words.hash[j : count - n + 1 + j]
        out[: count - n + 1] = mix(value + np.uint64(n))
        left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(count)
        whole = left >= n
    return out, whole


def pieces_of(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Slices of a batch with about ``limit`` bytes of text each; one row at least."""
    _, places = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(places, places[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the place of each row."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, type=kind))
