"""One query per operator, bound to the driver tables; SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann,
    conversations,
    jaccard_join,
    langid,
    licenses,
    maxscore,
    mixing,
    packing,
    quality,
    recompression,
    secrets,
    sql,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = packing.pack(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query("op2_secrets")
def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: counts by fixed pattern, their digest, and all spans."""
    found = secrets.find(table(spark, folder, "documents"))
    counts = [
        secrets.of_kind(F.col("spans"), kind).alias(f"n_{kind}")
        for kind in ("assign", "access", "hex")
    ]
    base = secrets.listed(secrets.base_only(F.col("spans")))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


@query("op3_topk", sql.TOP_K)
def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 rows of largest integer inner product for every 50th vector."""
    rows = maxscore.quantised(table(spark, folder, "embeddings"))
    return maxscore.top_k(rows.filter("vec_id % 50 = 0"), rows, k=5)


@query("op4_jaccard", sql.JACCARD)
def op4_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share three quarters of their 5-word shingles."""
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


@query("op5_quality")
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return quality.scored(table(spark, folder, "documents"), labels)


@query("op6_ann")
def op6_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows found for every 20th vector."""
    rows = table(spark, folder, "embeddings").withColumnRenamed("embedding", "vector")
    return ann.nearest(rows.filter("vec_id % 20 = 0"), rows, k=20)


@query("op7_mixing", sql.MIXING)
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of each document when sources weigh 3, 1, 2 and share 150% of all words."""
    plan = mixing.copy_plan(table(spark, folder, "documents"))
    return plan.select(
        "doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query("op8_langid")
def op8_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    return langid.predicted(table(spark, folder, "documents"))


@query("op9_licenses", sql.licences())
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence sentences of every document and the licences their rules yield."""
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select(
        "doc.doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


@query("op10_substrings", sql.SUBSTRINGS)
def op10_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without the 35-word windows that occur elsewhere."""
    found = recompression.deduplicated(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query("op11_whitening")
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first 8 whitened components of every vector."""
    rows = table(spark, folder, "embeddings").withColumnRenamed("embedding", "vector")
    return whitening.whitened(rows, 8).withColumn("deviation", F.col("deviation").cast("long"))


@query("op12_prefix_trie", sql.PREFIX_TRIE)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return conversations.trie(table(spark, folder, "conversations"))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels that are not held out."""
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return toxicity.scored(table(spark, folder, "documents"), labels)
