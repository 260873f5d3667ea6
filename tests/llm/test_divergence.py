import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_texts import ODD_TEXTS
from pyspark.sql import functions as F

from millrace.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(rows, least, top=50):
    """All sums over all kept terms, in plain integers."""
    groups, docs = {}, Counter()
    for lang, source, text in rows:
        found = words(text)
        groups.setdefault((lang or "", source or ""), Counter()).update(found)
        docs.update({(lang or "", t) for t in found})
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (at, t), n in docs.items() if at == lang and n >= least]
        mine = {s: c for (at, s), c in groups.items() if at == lang}
        whole = sum(mine.values(), Counter())
        shares = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in mine.items()}, shares(whole)
        for s in mine:
            parts = {
                "pair": [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in mine if o != s],
                "term": [(q[t] - p[s][t], t.encode()) for t in kept if mine[s][t] and p[s][t] > q[t]],
            }
            for part, found in parts.items():
                ranked = sorted(found)[: top if part == "term" else None]
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(ranked)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def site_rows(seed, n, sources):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "tion Über ñandú wa x ﬁ 字".split() for b in "a b c d e f g h i j k l m".split()]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "de", None])
        source = "hot" if rng.random() < 0.33 else f"s{rng.randrange(sources)}"
        some = rng.sample(vocabulary, 25) if source != "hot" else vocabulary[:40]
        rows.append((lang, source, " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(some, k=rng.randrange(40))) + rng.choice(["", ".", " 12 x's"])))
    return rows


@pytest.mark.parametrize("least", [1, 30])
def test_against_brute_force(spark, least):
    rows = site_rows(least, 600, 12) + [("en", None, None), ("fr", "a", "un deux"), ("fr", "b", ""), ("it", "only", "uno")] + [("de", "copies", "same words here")] * 40
    df = table(spark, rows).select("*", F.lit(1).alias("term"), F.lit(2).alias("base"), F.lit(3).alias("id"))
    got = divergence.audit(df, least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["value"] == "bigint"
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least)


def test_blocks_and_slices_add_up(spark):
    rows = site_rows(5, 500, 9)
    found = divergence.Audit(table(spark, rows), 3)
    want = sorted(tuple(r) for r in found.peers().collect())
    assert sorted(tuple(r) for r in found.peers(block=1, cells=20).collect()) == want
    assert [r[:3] + r[3:] for r in want] == [(a, s, i, v, k) for a, s, p, i, v, k in brute(rows, 3) if p == "pair"]


def test_rows_of_the_accumulator():
    rng = np.random.default_rng(3)
    shares = rng.integers(1, 1000, (7, 30))
    base = rng.integers(1, 1000, 7)
    has = rng.random((7, 30)) < 0.4
    has[0] = True
    has[6] = False
    whole = np.where(has, shares, base[:, None])
    g, t = np.nonzero(has)
    mixed = rng.permutation(len(g))
    g, t = g[mixed], t[mixed]
    got = dict(divergence.difference_rows(base, g, pa.array([f"t{x}" for x in t]), shares[g, t], range(1, 7, 2)))
    assert list(got) == [1, 3, 5]
    for row, acc in got.items():
        assert (acc == np.abs(whole[row] - whole).sum(axis=1)).all()


def test_shares_of_huge_counts(spark):
    n, total, kept = 3 * 10**17, 9 * 10**18, 10**9
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_odd_rows(spark, odd_docs, no_docs):
    got = divergence.audit(odd_docs, 1).collect()
    assert sorted(tuple(r) for r in got) == brute([("en", "s", t) for _, t in ODD_TEXTS], 1)
    assert divergence.audit(no_docs).count() == 0
