import hashlib
import random
import re

import pytest
from odd_texts import ODD_TEXTS

from millrace.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    out = []
    for d, t in rows:
        w = words(t)
        hit, ids = set(), set()
        for i, it in items:
            own = words(it)
            n = min(10, len(own))
            if not n:
                continue
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)}
            places = [k for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows]
            if places:
                if i is not None:
                    ids.add(str(i))
                for k in places:
                    hit.update(range(k, k + n))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def result(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    return sorted((tuple(r) for r in decontaminate.digest(got).collect()), key=repr)


ITEMS = [
    (1, "One two three, four five six; seven eight nine ten!"),
    (2, "few WORDS"),
    (3, None),
    (4, ""),
    (5, "?!"),
    (6, " ".join(f"w{k % 977}x{k % 31}" for k in range(500, 530))),
    (None, "seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (10, "nine"),
    (11, "few words"),
    (11, "few words"),
]


def test_odd_rows(spark, odd_docs):
    got = decontaminate.digest(decontaminate.decontaminate(odd_docs, spark.createDataFrame(ITEMS, "item_id long, text string")))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ODD_TEXTS, ITEMS)


@pytest.mark.parametrize("seed", range(3))
def test_random_passages(spark, seed):
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(12)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 2, 4, 5, 9, 10, 11, 15, 30])))) for k in range(25)]
    rows = []
    for d in range(60):
        w = [word() for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            own = items[rng.randrange(len(items))][1].split()
            a = rng.randrange(len(own))
            at = rng.randrange(len(w) + 1)
            w[at:at] = own[a : a + rng.randrange(1, 20)]
        rows.append((d, " ".join(w)))
    assert result(spark, rows, items) == brute(rows, items)


def test_shared_passage_and_repeats(spark):
    passage = " ".join(f"p{k}" for k in range(14))
    items = [(1, passage), (2, "a b c d e f g h i j"), (3, f"x {passage} y")]
    rows = [(k, f"start{k} {passage} middle {passage} end") for k in range(40)] + [(99, passage.replace("p7", "q"))]
    assert result(spark, rows, items) == brute(rows, items)


def test_empty_tables(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(no_docs, none).count() == 0
    assert decontaminate.decontaminate(odd_docs, none).where("n_hit > 0").count() == 0


def test_clean_drops_only_hit_documents(spark, odd_docs):
    kept = decontaminate.clean(odd_docs, spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string"))
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 3, 6, 7, 8, None, 9, 11, 12], key=repr)


def test_repeated_words_and_items_in_parts(spark, monkeypatch):
    """Runs of one word, alternating words, and a document that meets many items, some at a time."""
    monkeypatch.setattr(decontaminate, "PART_WORDS", 40)
    items = [(1, "a " * 30), (2, "a b " * 12), (3, "a " * 9 + "c"), (4, "a"), (5, "b a b")] + [(k, f"p{k} " + "x y z u v w r s t q " * 2) for k in range(10, 40)]
    rows = [(1, "a " * 200), (2, "b a " * 50), (3, "c " + "a " * 11 + "c"), (4, "z " * 30), (5, "x y z u v w r s t q " * 7), (6, "a " * 5), (7, None)]
    assert result(spark, rows, items) == brute(rows, items)


@pytest.mark.parametrize("unit", [["a"], ["a", "b"], "a b c d e f g".split()])
def test_repeats_take_linear_time(unit):
    import time

    import numpy as np
    import pyarrow as pa

    from millrace.llm import textscan

    text = lambda n: " ".join(unit * (n // len(unit)))
    doc, item = (textscan.scan(pa.array([text(n)]), textscan.ALNUM) for n in (200_000, 10_000))
    batch = pa.RecordBatch.from_pylist(
        [{"row": 1, "words": doc.hash.view(np.int64).tolist(), "places": decontaminate.winnow(doc).tolist(), "matches": [{"item_id": "i", "item_words": item.hash.view(np.int64).tolist()}]}]
    )
    start = time.process_time()
    (got,) = decontaminate._extend(iter([batch]))
    assert time.process_time() - start < 2
    assert got.to_pylist() == [{"row": 1, "spans": [{"start": 0, "stop": len(doc.hash)}], "items": ["i"]}]


def test_spans(spark):
    docs = spark.createDataFrame([(1, "s t one two three four five six seven eight nine ten u v w one two three four five six seven eight nine ten")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, "u v"), (3, "six seven eight nine ten u v w x")], "item_id long, text string")
    (got,) = decontaminate.decontaminate(docs, items).collect()
    assert [tuple(x) for x in got["spans"]] == [(2, 12), (12, 14), (15, 25)] and got["items"] == ["1", "2"]
