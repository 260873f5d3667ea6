import random
import zlib
from collections import Counter

import pytest
from odd_texts import ODD_TEXTS

from millrace.llm import sharding


def check(rows, docs, shards):
    want = sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == want
    slots = {s: [] for s in range(shards)}
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(v) for v in slots.values()]
    assert max(counts) - min(counts) <= 1


def cut(rows):
    """Documents outside the fullest shard of their group."""
    groups = {}
    for r in rows:
        if r["group"] is not None:
            groups.setdefault(r["group"], Counter())[r["shard"]] += 1
    return sum(sum(c.values()) - max(c.values()) for c in groups.values())


def test_odd_rows(spark, odd_docs):
    rows = sharding.shard(odd_docs, 4).collect()
    check(rows, ODD_TEXTS, 4)
    assert sum(r["group"] is not None for r in rows) == 3
    check(sharding.shard(odd_docs).collect(), ODD_TEXTS, 40)


def test_empty_table(spark, no_docs):
    assert sharding.shard(no_docs).count() == 0


def docs(seed, n, groups):
    rng = random.Random(seed)
    texts = [f"copy {g}" for g, size in enumerate(groups) for _ in range(size)]
    texts += [f"alone {k}" for k in range(n - len(texts))]
    rng.shuffle(texts)
    return list(enumerate(texts))


def together(rows):
    """Linked pairs within one shard."""
    groups = Counter((r["group"], r["shard"]) for r in rows if r["group"] is not None)
    return sum(n * (n - 1) // 2 for n in groups.values())


@pytest.mark.parametrize("groups, share", [([5] * 40 + [2] * 100, 0.95), ([400], 0.95), ([400, 300, 3, 3, 3], 0.8), ([1200], 1.0), ([600, 600], 0.7), ([2] * 600, 0.35)])
def test_groups_stay_together_within_the_law(spark, groups, share):
    rows = docs(1, 1200, groups)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(df).collect()
    check(got, rows, 40)
    best = sum(g // 30 * 435 + (g % 30) * (g % 30 - 1) // 2 for g in groups)  # 30 documents in a shard
    assert together(got) >= share * best


def test_without_rounds(spark):
    rows = docs(1, 1200, [5] * 40)
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), rounds=0).collect()
    check(got, rows, 40)


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.shard(df).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], 40)
    assert cut(rows) <= 1


def test_pairs_meet_where_shards_have_room(spark):
    rows = docs(2, 4000, [2] * 600 + [7] * 50)
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(got, rows, 40)
    assert together(got) >= 0.97 * (600 + 50 * 21)


def test_shards_do_not_depend_on_input_partitions(spark):
    rows = docs(3, 900, [300, 40, 5, 5, 2]) + [(5, "copy 0")] * 3 + [(None, None)] * 4 + [(None, "copy 0")] * 2
    found = []
    for parts in (1, 2, 8, 13):
        got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        check(got, rows, 40)
        found.append(sorted(map(repr, got)))
    assert all(f == found[0] for f in found)
