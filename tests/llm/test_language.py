import numpy as np
import pyarrow as pa
from odd_texts import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(language.training(docs))
    got = language.identify(docs.drop("lang", "source"), model).withColumn("held_out", language.held_out()).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert 0.25 < held.count() / docs.count() < 0.42
    assert held.where("lang_pred = lang").count() / held.count() > 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_spans_of_mixed_texts_and_scripts(spark):
    rows = [(k, t, l) for k, (t, l) in enumerate([("the cat and the dog with that thing", "en"), ("der hund und die katze nicht mit ein", "de"), ("это просто русский текст", "ru"), ("αυτό είναι ένα κείμενο", "el")] * 30)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    text = "the thing and the cat with that dog the cat der hund und die katze mit ein und die katze это русский текст"
    (r,) = language.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [(s["lang"], s["start"], s["stop"]) for s in r["spans"]] == [("en", 0, 10), ("de", 10, 20), ("ru", 20, 23)]
    # a word beyond the scripts of Latin languages can't be one of theirs
    (r,) = language.identify(spark.createDataFrame([(1, "абвгд")], "doc_id long, text string"), model).collect()
    assert r["lang_pred"] == "ru"


def test_odd_rows(spark, odd_docs, no_docs):
    learned = language.learn(spark.createDataFrame([(1, "one two three", "en"), (2, None, "fr"), (3, "un deux", None)], "doc_id long, text string, lang string"))
    assert learned.langs == ["en"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd_docs, learned).collect()}
    assert len(got) == len({d for d, _ in ODD_TEXTS})
    for doc in (1, 2, 3, 9):
        assert got[doc] == ("und", 0.0)
    assert got[4] == ("en", 1.0)
    assert language.identify(no_docs, learned).count() == 0
    nothing = language.learn(no_docs)
    assert {r["lang_pred"] for r in language.identify(odd_docs, nothing).collect()} == {"und"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 7), min_size=1, max_size=5), st.integers(0, 10_000), st.floats(0, 4))
def test_viterbi_is_the_best_path(sizes, seed, switch):
    rng = np.random.default_rng(seed)
    first = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(size=(first[-1], 3))
    labels = language._viterbi(scores, first, switch)

    def value(path, own):
        return sum(own[k][l] for k, l in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:], strict=False))

    for a, b in zip(first[:-1], first[1:], strict=True):
        own = scores[a:b]
        best = [[]]
        for _ in range(b - a):
            best = [p + [l] for p in best for l in range(3)]
        assert value(labels[a:b].tolist(), own) >= max(value(p, own) for p in best) - 1e-9


def test_word_scores_do_not_depend_on_neighbours():
    model = language.Model(["a", "b"], np.random.default_rng(0).normal(size=(1 << language.BITS, 2)).astype(np.float32), np.zeros((64, 2)))
    together, _, first = language.word_scores(pa.array(["some words", None, "here"]), model)
    alone, _, _ = language.word_scores(pa.array(["here"]), model)
    assert first.tolist() == [0, 2, 2, 3] and np.allclose(together[2], alone[0])


def test_scripts_leave_candidates_only(spark):
    """A language learned from one line has high scores for what it never saw, but not in another's script."""
    rows = [(1, "αυτό είναι ένα κείμενο με πολλές λέξεις και γράμματα " * 400, "el"), (2, "one line", "en"), (3, "eine zeile", "de")]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    scores, _, _ = language.word_scores(pa.array(["ξψχφυτσρπονμλκιθη line"]), model)
    greek, latin = (dict(zip(model.langs, x, strict=True)) for x in scores)
    assert greek == {"el": 0.0, "en": -np.inf, "de": -np.inf}
    assert latin["el"] == -np.inf and latin["en"] > latin["de"] > -np.inf
    got = language.identify(spark.createDataFrame([(1, "ξψχφυτσρπονμλκιθη"), (2, "line ξψχφ line")], "doc_id long, text string"), model)
    assert {r["doc_id"]: [(s["lang"], s["start"], s["stop"]) for s in r["spans"]] for r in got.collect()} == {1: [("el", 0, 1)], 2: [("en", 0, 1), ("el", 1, 2), ("en", 2, 3)]}


def test_identify_against_brute_force(spark):
    """Counts, word scores and every path of short texts, by plain Python."""
    import itertools
    import math
    import re
    from collections import Counter

    train = [("a cat and a dog", "en"), ("der hund und katze", "de"), ("кот и пёс", "ru"), ("the cat", "en"), ("кот the", "ru"), (None, "de"), ("x", None)]
    model = language.learn(spark.createDataFrame([(k, t, l) for k, (t, l) in enumerate(train)], "doc_id long, text string, lang string"))
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.lower())
    script = lambda w: "cyrillic" if any("\u0400" <= c < "\u0530" for c in w) else "latin"

    def grams(word):
        b = b"\0" + word.encode() + b"\0"
        return [int.from_bytes(b[k : k + 3], "big") * 0x9E3779B1 % 2**32 >> (32 - language.BITS) for k in range(len(b) - 2)]

    langs = ["de", "en", "ru"]
    own = {lang: [w for t, l in train if t and l == lang for w in words(t)] for lang in langs}
    counts = {lang: Counter(g for w in own[lang] for g in grams(w)) for lang in langs}

    def score(word, lang):
        used = [x for x in langs if sum(script(w) == script(word) for w in own[x]) >= language.RARE * len(own[x]) and any(script(w) == script(word) for w in own[x])]
        if lang not in used:
            return -math.inf
        total = sum(counts[lang].values()) + language.SMOOTHING * 2**language.BITS
        return sum(math.log((counts[lang][g] + language.SMOOTHING) / total) for g in grams(word)) if len(used) > 1 else 0.0

    texts = ["cat und dog hund", "кот cat der", "the the katze katze", "пёс", "zzz кот zzz", "a"]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for k, text in enumerate(texts):
        own_words = words(text)
        value = lambda path: sum(score(w, l) for w, l in zip(own_words, path, strict=True)) - language.SWITCH * sum(a != b for a, b in itertools.pairwise(path))  # noqa: B023, E731
        path = [s["lang"] for s in got[k]["spans"] for _ in range(s["start"], s["stop"])]
        assert value(path) >= max(map(value, itertools.product(langs, repeat=len(own_words)))) - 1e-3
        share = Counter()
        for w, l in zip(own_words, path, strict=True):
            share[l] += len(w.encode())
        top = max(share.values())
        assert got[k]["lang_pred"] == min(l for l in share if share[l] == top) and abs(got[k]["score"] - top / sum(share.values())) < 1e-9
