"""Best-fit packing of token sequences, planned over counts of lengths.

Pieces are counted by length. The plan places lengths from long to short, each
into the bins with the least room that still takes it; bins that are alike are
one range, so the plan costs no more for a billion documents than for a
thousand. Pieces then take their planned place by joining on length and their
rank within it.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textscan
from millrace.llm.ranks import bucket, rank_within
from millrace.session import stage

CAPACITY = 1024
END = 2  # id after every document
VOCABULARY = "byte_bpe_50k"
PLAN_ROWS = 200_000  # a plan of up to so many rows (10 MB) is broadcast
BUCKETS = 4096  # of each length, for ranking


@functools.cache
def _encoders(vocabulary: str):
    """The vocabulary for two libraries that give the same ids.

    Both take the vocabulary's special tokens for what they are wherever a text spells them out. The fast
    one takes text by ranks; a run of very much white space, at which its
    pattern matching gives up, goes to the other.
    """
    import base64
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(public_tokenizers.path(f"{vocabulary}.json")) as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    ranks = {k: v for k, v in ranks.items() if v not in special.values()}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    return lambda text: fast.encode(text, allowed_special="all"), lambda text: whole.encode(text, add_special_tokens=False).ids


_BLANKS = re.compile(r"\s{5000}")


def token_ids(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    fast, whole = _encoders(vocabulary)
    return whole(text) if _BLANKS.search(text) else fast(text)


def piece_bounds(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: whole ones, after a shorter first one if need be."""
    first = length % capacity or min(capacity, length)
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


def _pieces(vocabulary: str, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textscan.pieces_of(batch, "text", 4 << 20):
                source, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, text in enumerate(part.column("text")):
                    ids = np.array([*token_ids(text.as_py() or "", vocabulary), END], dtype="<u4")
                    for n, (at, size) in enumerate(piece_bounds(len(ids), capacity)):
                        own = ids[at : at + size]
                        source.append(i)
                        piece.append(n)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(own.tobytes()))
                        kept.append(own if keep_ids else None)
                columns = [
                    part.column("doc_id").take(pa.array(source, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in kept], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Rows ``(length, low, high, sequence, each, offset)``: pieces of ``length`` with rank r
    in ``low <= r < high`` go to sequence ``sequence + (r - low) // each`` at
    ``offset + (r - low) % each * length``.
    """
    rows: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens: ranges (first sequence, how many)
    used = 0

    def fill(length: int, rank: int, left: int, free: int, first: int, many: int) -> int:
        """Fill bins ``first ..`` of ``free`` tokens each, one after the other; returns the next rank."""
        each = free // length
        whole = min(many, left // each)
        rest = left - whole * each if whole < many else 0
        for bins, take in ((whole, each), (min(1, rest), rest)):
            if bins:
                rows.append((length, rank, rank + take * bins, first, take, capacity - free))
                room.setdefault(free - take * length, []).append((first, bins))
                rank, first, many = rank + take * bins, first + bins, many - bins
        if many:
            room.setdefault(free, []).append((first, many))
        return rank

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        for free in sorted(f for f in room if f >= length):
            if rank == total:
                break
            ranges = room.pop(free)
            for at, (first, many) in enumerate(ranges):
                if rank == total:
                    room.setdefault(free, []).extend(ranges[at:])
                    break
                rank = fill(length, rank, total - rank, free, first, many)
        if rank < total:
            bins = -(-(total - rank) // (capacity // length))
            rank = fill(length, rank, total - rank, capacity, used, bins)
            used += bins
    return rows


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents and their place in sequences of at most ``capacity`` tokens.

    ``docs``: ``doc_id``, ``text``; more columns are ignored. Null and empty texts are the
    end id alone. A row per piece: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``, and ``ids`` with ``keep_ids``. Repeated rows
    are packed each; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = stage(
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .mapInArrow(
            _pieces(vocabulary, capacity, keep_ids),
            f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids,
        )
        .withColumn("row", F.monotonically_increasing_id())
    )
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    planned = plan(counts, capacity)
    schema = "length long, low long, high long, sequence long, each long, at long"
    slots = docs.sparkSession.createDataFrame(planned, schema)
    ranked = rank_within(pieces.withColumn("bucket", bucket("row", n=BUCKETS)), ["length"], "bucket", ["row"], "rank")
    r, s = ranked.alias("r"), (F.broadcast(slots) if len(planned) <= PLAN_ROWS else slots).alias("s")
    inside = (F.col("r.length") == F.col("s.length")) & (F.col("r.rank") >= F.col("s.low")) & (F.col("r.rank") < F.col("s.high"))
    past = F.col("r.rank") - F.col("s.low")
    return r.join(s, inside).select(
        "r.doc_id",
        "r.piece",
        "r.start",
        "r.length",
        "r.ids_crc32",
        (F.col("s.sequence") + F.floor(past / F.col("s.each"))).alias("sequence_id"),
        (F.col("s.at") + past % F.col("s.each") * F.col("r.length")).alias("offset"),
        *(["r.ids"] if keep_ids else []),
    )
