"""Cleaning a corpus in stages; each is written as Parquet and read again as the next one's input.

In every stage but the last, rows keep all their columns, also others than those of documents and
nulls in any of them; texts are read whole, however long; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, mixing, packing, quality, secrets
from tidemark.session import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to `labels`, does not reject.

    A null text is judged as an empty one. Each row is judged by its text alone, so repeated rows and
    rows without an id stay or go together with their like; a score of exactly 0.5 stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.accepted(docs, labels)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group that 5-word shingles link at 0.75.

    Null, empty and blank texts link with nothing and stay. Rows that repeat an id are one document,
    of which the smallest text stays. Rows without an id stay, whatever they link with.
    """
    return jaccard_join.one_per_group(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark, and n_chars counted anew.

    A null text stays null and keeps its n_chars. Overlapping secrets become one mark. Copies count
    once where the cut-offs are set, and each is redacted alike.
    """
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return secrets.redact(docs).withColumn("n_chars", size)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources come near their target weights.

    A null source is a source, the last one. Null and empty texts have no words, so they sway no
    target. Rows that repeat an id, or have none, are drawn one by one.
    """
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids; copies of a document are packed separately.

    A null or empty text is its closing id alone. A row without an id is packed with a null one. An
    empty table gives no pieces. Columns other than doc_id and text are not read.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# SQL cannot express the classifier, the randomness tests or the packing; tests/llm holds the stages
# against brute force on small rows and against their operators on the given tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
