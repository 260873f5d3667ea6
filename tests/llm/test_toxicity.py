import numpy as np
import pyarrow as pa
import pytest
from odd_texts import ODD_TEXTS

from millrace.llm import toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.learn(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


@pytest.fixture(scope="module")
def big(spark):
    """Held-out accuracy needs more labels than the small tables have."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learned = toxicity.learn(docs, labels)
    return learned, toxicity.score(docs, learned).withColumn("held_out", toxicity.held_out()).join(labels, "doc_id")


def test_held_out_accuracy(big):
    _, scored = big
    held = scored.where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in held)
    alarms = sum(r["predicted"] and not r["toxic"] for r in held)
    assert right / len(held) > 0.95 and alarms / len(held) < 0.01
    assert all(0 <= r["score"] <= 1 for r in held)


@pytest.mark.parametrize(
    "seen, meant",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("$tupid", "stupid"), ("tr@sh", "trash"), ("i.d.i.o.t", "idiot"), ("c-l-o-w-n", "clown"), ("stuuuuupid", "stupid"), ("p4th3tic", "pathetic"), ("idio7,", "idiot")],
)
def test_restores_disguised_words(big, seen, meant):
    read = toxicity._reader(big[0].characters)
    (tokens,) = toxicity.suspects(pa.array([f"you {seen} there"]))
    assert [read(t) for t in tokens] == [meant]


def test_disguised_words_count(spark, big):
    texts = ["what an idiot and a loser", "what an 1d10t and a l0s3r", "what an i d i o t and a loooser", "what a nice day", "call 555 1234 at 10:30 on 2024-01-01"]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), big[0]).collect()}
    assert [got[k] for k in range(5)] == [1, 1, 1, 0, 0]


def test_suspects_leave_plain_text_alone():
    texts = ["plain words, with (marks)!", "it's 10:30 on 2024-01-01", None, "", "a$$$ the&&& c### x", "aa bb cc", "é ç b"]
    assert toxicity.suspects(pa.array(texts)) == [[], [], [], [], [], [], ["é ç b"]]


def test_odd_rows(spark, odd_docs, no_docs, model):
    got = toxicity.score(odd_docs, model)
    assert got.count() == len(ODD_TEXTS) and got.where("score is null or predicted is null").count() == 0
    assert got.where("doc_id in (1, 2, 3)").select("score").distinct().count() == 1
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.reject(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == len(ODD_TEXTS)


def test_without_labels_nothing_is_toxic(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for docs in (odd_docs, no_docs):
        learned = toxicity.learn(docs, none)
        assert len(learned.features) == 0
        assert toxicity.score(odd_docs, learned).where("predicted = 1").count() == 0
    strange = spark.createDataFrame([(None, 1, 1), (4, None, None), (5, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.learn(odd_docs, strange).base <= 0.45


def test_rare_words_of_toxic_copies_are_not_chosen():
    # feature 0 explains all; features 1..9 only stand in some of the same documents
    documents = [[0, *range(1, 10)] if d < 40 else [0] for d in range(100)]
    bad = np.array([100.0] + [40.0] * 9)
    chosen, left = toxicity._choose(documents, bad, np.zeros(10), np.full(10, 3))
    assert chosen == [0] and left == 0


def test_no_feature_is_cut(spark):
    """The chosen features are those that plain counts over all features of the labelled texts give."""
    from collections import defaultdict

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.learn(docs, labels)
    sample = {r["doc_id"]: r["toxic"] for r in toxicity.labelled_sample(labels).collect()}
    toxic_of = defaultdict(bool)
    for r in docs.where("text is not null").collect():
        if r["doc_id"] in sample:
            toxic_of[r["text"]] |= sample[r["doc_id"]]
    texts = pa.array(toxic_of)
    value, owner = toxicity._distinct(texts, toxicity._restore(texts, toxicity._reader(model.characters)), len(texts))
    has = defaultdict(set)
    for v, d in zip(value.tolist(), owner.tolist(), strict=True):
        has[v].add(d)
    is_toxic = list(toxic_of.values())
    every = {v: (sum(is_toxic[d] for d in own), len(own)) for v, own in has.items() if len(own) >= toxicity.LEAST_DOCS}
    names = sorted(v for v, (bad, n) in every.items() if bad >= toxicity.LEAST_DOCS and bad >= toxicity.LEAST_PRECISION * n)
    bad, good = (np.array([f(*every[v]) for v in names], dtype=float) for f in (lambda b, n: b, lambda b, n: n - b))
    least = toxicity._least_support(good, min(0.5, max(sum(is_toxic), 1) / max(len(is_toxic), 2)), len(every))
    own = [[k for k, v in enumerate(names) if d in has[v]] for d in range(len(is_toxic)) if is_toxic[d]]
    chosen, _ = toxicity._choose(own, bad, good, least)
    chosen = {*chosen, *np.flatnonzero((good == 0) & (bad >= max(10, toxicity.COMMON * sum(is_toxic)))).tolist()}
    assert chosen and model.features.tolist() == [names[k] for k in sorted(chosen)]
