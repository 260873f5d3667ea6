"""Registered queries: those with SQL agree with it; the pipeline agrees with brute force."""

import importlib
import inspect

import pytest
from odd_texts import ODD_TEXTS

from millrace.llm.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    from oracle_check import duck

    return duck(sf)


@pytest.mark.parametrize("name", list(ORACLES))
def test_agrees_with_sql(spark, con, sf, name):
    from oracle_check import compare

    ok, note = compare(spark, con, name, QUERIES[name], ORACLES[name], sf)
    assert ok, note


def test_one_query_for_each_operator():
    names = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert names == list(range(1, 14)) and "pipeline" in QUERIES
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


COLUMNS = {
    "op1_extract": [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")],
    "op2_shard": [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")],
    "op3_pack": [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")],
    "op4_vectors": [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")],
    "op5_language": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op6_minhash": [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")],
    "op7_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op9_decontaminate": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"), ("items_sha256", "string"), ("contaminated", "boolean")],
    "op11_chat": [("conv_id", "bigint"), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"), ("loss_sha256", "string"), ("formatted_chars", "bigint")],
    "op12_centroids": [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")],
    "op13_divergence": [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")],
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, sf, name):
    assert QUERIES[name](spark, sf).dtypes[: len(COLUMNS[name])] == COLUMNS[name]


def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline
    from test_decontaminate import brute as leaks
    from test_lines import brute as cut
    from test_minhash import brute as copies

    from millrace.llm import packing, toxicity

    assert inspect.isfunction(corpus_pipeline.run) and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.score(docs, toxicity.learn(docs, labels)).where("predicted = 1").collect()}
    rows = [r for r in docs.collect() if r["doc_id"] not in toxic]
    texts = {r["doc_id"]: r["text"] for r in rows}
    # the brute-force cut loses ids, so it is done text by text with a mark
    tagged = {}
    for h, t, *_ in cut([(r["source"], r["text"]) for r in rows]):
        tagged.setdefault(h, []).append(t)
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_boilerplate(spark, docs.where(~docs.doc_id.isin(list(toxic))), sf).collect()}
    assert {h: sorted(v) for h, v in tagged.items()} == {h: sorted(found[r["doc_id"]] for r in rows if r["source"] == h) for h in tagged}
    assert set(found) == set(texts)
    kept = [d for d, _, _, k in copies(sorted(found.items())) if k]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = sorted(d for d, *_, bad in leaks([(d, found[d]) for d in kept], items) if not bad)
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted({r["doc_id"] for r in got}) == clean
    lengths = {d: len(packing.token_ids(found[d])) + 1 for d in clean}
    by = {}
    for r in got:
        by[r["doc_id"]] = by.get(r["doc_id"], 0) + r["length"]
    assert by == lengths


def test_stages_keep_the_columns(spark, odd_docs, no_docs, sf):
    stages = importlib.import_module("corpus_pipeline").STAGES
    docs = odd_docs.drop("label")
    for docs in (docs, no_docs):
        columns = docs.columns
        for _, step in stages[:-1]:
            docs = step(spark, docs, sf)
            assert docs.columns == columns
        assert stages[-1][1](spark, docs, sf).count() >= (1 if "row" in columns else 0)
    assert len(ODD_TEXTS) > 5
