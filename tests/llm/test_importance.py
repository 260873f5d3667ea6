import math

from odd_texts import ODD_TEXTS
from pyspark.sql import functions as F

from millrace.llm import importance


def test_selects_the_share_with_the_largest_keys(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = importance.resample(docs, labels).collect()
    assert len(rows) == docs.count()
    chosen = [r["sample_key"] for r in rows if r["selected"]]
    assert len(chosen) == math.ceil(len(rows) / 2)
    assert min(chosen) >= max(r["sample_key"] for r in rows if not r["selected"])


def test_weights_are_sums_of_log_ratios(spark):
    """Against counts with words as they are; hashing into buckets has no collisions here."""
    texts = ["good words here", "bad words there", "good good there", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    grams = [[*(w := (t or "").split()), *zip(w, w[1:], strict=False)] for t in texts]
    raw, target = {}, {}
    for k, own in enumerate(grams):
        for g in own:
            raw[g] = raw.get(g, 0) + 1
            target[g] = target.get(g, 0) + (k in (0, 2))
    size = 1 << importance.BITS
    n, m = sum(raw.values()) + size, sum(target.values()) + size
    want = [sum(math.log((target[g] + 1) / m) - math.log((raw[g] + 1) / n) for g in own) for own in grams]
    got = {r["doc_id"]: r["log_weight"] for r in importance.resample(docs, labels).collect()}
    assert all(abs(got[k] - w) < 1e-9 for k, w in enumerate(want))


def test_ranks_good_documents_higher(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = importance.resample(docs, labels.where(~fold)).join(labels.where(fold), "doc_id")
    pairs = [(r["log_weight"], r["quality"]) for r in got.collect()]
    good, bad = [w for w, q in pairs if q], [w for w, q in pairs if not q]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.7


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = importance.resample(odd_docs, labels)
    assert got.count() == len(ODD_TEXTS) and got.where("selected").count() == math.ceil(len(ODD_TEXTS) / 2)
    assert importance.resample(no_docs, labels).count() == 0
