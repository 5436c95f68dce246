"""Vector tables: which rows take part, and searches of query blocks against row shards."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import workers

SHARD_ROWS = 8192
QUERY_ROWS = 2048

Search = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def partaking(rows: DataFrame) -> DataFrame:
    """(vec_id, vector) without null ids and unusable vectors, one row an id.

    Of rows that repeat an id, the one with the smallest vector stands.
    """
    kept = rows.select("vec_id", "vector").filter(
        F.col("vec_id").isNotNull() & usable(F.col("vector"))
    )
    return kept.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def dense(vectors: pd.Series) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    width = max(map(len, vectors))
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def pieces(rows: DataFrame, size: int) -> int:
    """How many pieces of about `size` rows a table is cut into."""
    return max(1, math.ceil(rows.count() / size))


def dealt(n: int) -> Column:
    """The piece of n that a row goes to."""
    return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")


def search(
    queries: DataFrame,
    rows: DataFrame,
    k: int,
    within: Search,
    score: str,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: every query block meets every row shard once.

    `within` gets a block and a shard of (vec_id, vector) and returns the k best rows of the shard
    for each query; the lists of the shards are merged by score, ties to the smaller vec_id. Blocks
    and shards are cut by hash and bounded in size, so no vector, however frequent, makes a large
    task.
    """
    workers.ready(rows.sparkSession)
    shards, blocks = pieces(rows, shard_rows), pieces(queries, query_rows)

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = rows.withColumn("shard", dealt(shards)).withColumn("block", everywhere(blocks))
    queries = queries.withColumn("block", dealt(blocks)).withColumn("shard", everywhere(shards))

    def meet(block: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if len(block) and len(shard):
            found = within(block, shard)
            workers.release()
            return found
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = (
        queries.groupBy("shard", "block")
        .cogroup(rows.groupBy("shard", "block"))
        .applyInPandas(meet, f"query_id long, vec_id long, score {score}")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
