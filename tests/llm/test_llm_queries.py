"""Every operator's query against its SQL, and the pipeline stage by stage."""

import os

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
import oracle
from tidemark.llm import jaccard_join, mixing, packing, quality, queries, secrets

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, db, name):
    assert oracle.compare(spark, FOLDER, db, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_all_are_registered():
    names = set(entry_module.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, FOLDER).cache()
        held[name] = (before, docs)
        if name != "packing":
            assert docs.schema.simpleString() == before.schema.simpleString()
    before, after = held["quality"]
    rejected = {r.doc_id for r in quality.scored(before, labels).filter("predicted = 0").collect()}
    ids = {r.doc_id for r in before.collect()}
    assert rejected and {r.doc_id for r in after.collect()} == ids - rejected
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    assert len(rejected & bad) > 0.9 * len(ids & bad)
    before, after = held["near_duplicates"]
    groups = jaccard_join.near_duplicates(before).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in groups})
    before, after = held["secrets"]
    spans = {r.doc_id: r.spans for r in secrets.find(before).collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert any(spans.values())
    for r in after.collect():
        assert ("[secret]" in r.text) == bool(spans[r.doc_id]) and r.n_chars == len(r.text)
        assert spans[r.doc_id] or r.text == texts[r.doc_id]
    before, after = held["mixing"]
    copies = {r.doc.doc_id: r.copies for r in mixing.copy_plan(before).collect()}
    found: dict = {}
    for r in after.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {k: v for k, v in copies.items() if v}
    before, after = held["packing"]
    encode = packing.encoder(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(encode(r.text)) + 1 for r in before.collect())
    pieces = after.selectExpr("length", "length(ids) AS bytes").collect()
    assert sum(p.length for p in pieces) == tokens and all(p.bytes == 4 * p.length for p in pieces)


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and "ids" in rows.columns
