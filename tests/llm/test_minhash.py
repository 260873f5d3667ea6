import random
import re

from odd_texts import ODD_TEXTS

from millrace.llm import minhash


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(
        ((d, len(sets[i]), least.get(find(i)) if sets[i] else d, d == (least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows)), key=repr
    )


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=repr)


def test_odd_rows(spark, odd_docs):
    assert result(minhash.near_duplicates(odd_docs)) == brute(ODD_TEXTS)


def test_empty_table(spark, no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.keep_one(no_docs).columns == no_docs.columns


def test_groups_chains_and_common_passages(spark):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    base = [word() for _ in range(120)]
    texts += [" ".join(base)] * 60  # exact copies
    for _ in range(60):  # near copies of many degrees
        own = list(base)
        for _ in range(rng.randrange(1, 8)):
            own[rng.randrange(len(own))] = word()
        texts.append(" ".join(own))
    chain = [word() for _ in range(100)]
    for k in range(12):  # each close to the next only
        texts.append(" ".join(chain[k * 6 : k * 6 + 60]))
    passage = " ".join(word() for _ in range(40))
    texts += [f"{' '.join(word() for _ in range(50))} {passage}" for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = result(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)


def test_threshold_is_exact(spark):
    # 7 of 9 shingles in common is 0.78, 6 of 8 is 0.75, 5 of 7 is 0.71
    a = [f"x{k}" for k in range(12)]
    for cut, linked in ((1, True), (2, True), (3, False)):
        x, y = a[:12], a[:12]
        y = y[: 12 - cut]
        got = minhash.near_duplicates(docs_of(spark, [" ".join(x), " ".join(y)])).collect()
        common, union = len(y) - 4, len(x) - 4
        assert (100 * common >= 75 * union) == linked
        assert (len({r["component_id"] for r in got}) == 1) == linked


def test_keep_one_keeps_columns_and_one_of_each(spark, odd_docs):
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 3, 4, 6, 8, None, 9, 11, 12], key=repr)
