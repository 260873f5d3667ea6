import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from odd_texts import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing


def ids_of(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*e.ids, 2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, texts_by_id, capacity=1024):
    for r in rows:
        ids = texts_by_id[r["doc_id"]]
        own = ids[r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(np.array(own, dtype="<u4").tobytes()) == r["ids_crc32"]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_odd_rows_round_trip(spark, odd_docs):
    rows = packing.pack(odd_docs, keep_ids=True).collect()
    ids = dict(zip([d for d, _ in ODD_TEXTS], ids_of([t for _, t in ODD_TEXTS]), strict=True))
    check(rows, ids)
    pieces = sum(-(-len(x) // 1024) for x in ids.values()) + 1  # one row is there twice
    assert len(rows) == pieces
    for doc, want in ids.items():
        if doc != 5:
            own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["piece"])
            assert [x for r in own for x in r["ids"]] == want
            assert all(r["length"] == 1024 for r in own[1:]) and [r["piece"] for r in own] == list(range(len(own)))


def test_special_tokens_in_texts():
    rng = random.Random(8)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a b", "don't", "  ", "ünï", "<|", "字", "\t", "12345", "<|endoftext|", "🙂"]
    texts = ["abc <|endoftext|> def", "<|endoftext|>", "<|endoftext|><|endoftext|>", "  <|endoftext|>  "]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(5000)]
    assert [[*packing.token_ids(t), 2] for t in texts] == ids_of(texts)
    assert 50256 in packing.token_ids(texts[0])


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    ids = dict(zip([d for d, _ in pairs], ids_of([t for _, t in pairs]), strict=True))
    rows = packing.pack(docs).collect()
    used = check(rows, ids)
    assert used <= 1.02 * -(-sum(map(len, ids.values())) // 1024) + 1


def test_empty_table(spark, no_docs):
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("text", [" " * 300_000 + "x", "\n" * 60_000, "a" * 50_000, "<|endoftext|> x", "é" * 9000 + "  \t\n z", "1234567890" * 3000])
def test_ids_of_hard_texts(text):
    assert [*packing.token_ids(text), 2] == ids_of([text])[0]


def test_piece_bounds():
    assert packing.piece_bounds(1) == [(0, 1)]
    assert packing.piece_bounds(1024) == [(0, 1024)]
    assert packing.piece_bounds(1025) == [(0, 1), (1, 1024)]
    assert packing.piece_bounds(2048) == [(0, 1024), (1024, 1024)]


def best_fit(lengths, capacity):
    """Best-fit decreasing over single items: number of bins by room left."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k in range(len(room)) if room[k] >= n]
        if fits:
            k = min(fits, key=lambda j: room[j])
            room[k] -= n
        else:
            room.append(capacity - n)
    return sorted(room)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120), st.integers(30, 40))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows = packing.plan(counts, capacity)
    used, seen = {}, {n: [] for n in counts}
    for length, low, high, sequence, each, offset in rows:
        for r in range(low, high):
            seen[length].append(r)
            used.setdefault(sequence + (r - low) // each, []).append((offset + (r - low) % each * length, length))
    assert all(sorted(v) == list(range(counts[n])) for n, v in seen.items())
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == best_fit(lengths, capacity)


def test_plan_does_not_grow_with_counts():
    rng = random.Random(2)
    counts = {n: rng.randrange(1, 9) for n in range(1, 1025)}
    assert len(packing.plan({n: c * 1_000_003 for n, c in counts.items()})) <= 12 * 1024
