"""The stages of the pipeline on odd and planted rows, by definition, and run() as their sequence."""

import re
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import packing

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def one_of_each_group(rows):
    """Ids that stay, by comparing all pairs of sets."""
    sets = {}
    for i, text in sorted(rows, key=lambda r: (str(r[0]), r[1] or "")):
        if i is not None:
            sets.setdefault(i, shingles(text))
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return Counter([i for i in sets if root(i) == i] + [i for i, _ in rows if i is None])


def test_near_duplicates_of_odd_rows(spark, odd_docs, texts_of):
    found = STAGES["near_duplicates"](spark, odd_docs, FOLDER)
    assert found.schema == odd_docs.schema
    assert Counter(r.doc_id for r in found.collect()) == one_of_each_group(texts_of)


def test_quality_of_odd_rows(spark, odd_docs):
    """Rows of equal text go together, whatever their other columns."""
    labelled = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = labelled.unionByName(odd_docs.select(*labelled.columns).withColumn("doc_id", -F.abs("doc_id") - 10**9))
    found = STAGES["quality"](spark, docs, FOLDER)
    assert found.schema == docs.schema
    kept = Counter(r.text for r in found.collect())
    every = Counter(r.text for r in docs.collect())
    assert all(kept[t] in (0, n) for t, n in every.items()) and 0 < len(kept) < len(every)


def test_secrets_of_odd_and_planted_rows(spark, odd_docs):
    key = "AKIA" + "Q7ZK2M9XW4LP8RT3"
    docs = odd_docs.withColumn(
        "text", F.when(F.col("doc_id") == 8, F.concat("text", F.lit(f" id {key}."))).otherwise(F.col("text"))
    )
    found = STAGES["secrets"](spark, docs, FOLDER)
    assert found.schema.simpleString() == docs.schema.simpleString()
    was = Counter((r.doc_id, r.text, r.n_chars if r.text is None else len(r.text)) for r in docs.collect())
    now = Counter((r.doc_id, r.text, r.n_chars) for r in found.collect())
    clean = {k: v for k, v in was.items() if k[0] != 8}
    assert now == Counter(clean) + Counter({(8, "short id [secret].", 18): 2})


def test_mixing_of_odd_rows(spark, odd_docs):
    found = STAGES["mixing"](spark, odd_docs, FOLDER)
    assert found.schema == odd_docs.schema
    given = Counter((r.doc_id, r.text, r.source) for r in odd_docs.collect())
    copies = Counter((r.doc_id, r.text, r.source) for r in found.collect())
    assert set(copies) <= set(given) and all(n <= 2 * given[r] for r, n in copies.items())


def test_packing_of_odd_rows(spark, odd_docs, texts_of):
    pieces = STAGES["packing"](spark, odd_docs, FOLDER).collect()
    encode = packing.encoder(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter((i, x) for i, text in texts_of for x in [*encode(text or ""), 1])
    assert expected == Counter(
        (p.doc_id, x) for p in pieces for x in struct.unpack(f"<{p.length}I", bytes(p.ids))
    )
    held: dict = {}
    for p in pieces:
        held.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in held.values():
        ends = [0] + [offset + length for offset, length in sorted(parts)]
        assert [offset for offset, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_an_empty_table(spark, no_docs, name):
    found = STAGES[name](spark, no_docs, FOLDER)
    assert found.count() == 0
    assert name == "packing" or found.schema.simpleString() == no_docs.schema.simpleString()


def test_run_gives_the_rows_of_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()

    def tokens(pieces):
        total = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
        return Counter(map(tuple, total.collect()))

    assert tokens(corpus_pipeline.run(spark, FOLDER)) == tokens(docs) != Counter()
