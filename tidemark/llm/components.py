"""Connected components by alternating stars, round by round through the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import workers
from tidemark.session import discard, stored

HELD_EDGES = 1 << 20


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node joined to it) for every node of the edges that is not the smallest."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = np.minimum(new, new[new])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _local_forests(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: forests of the edges that a task holds at a time."""

    @workers.lean
    def forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for frame in frames:
            a, b = np.concatenate([a, frame.a]), np.concatenate([b, frame.b])
            if len(a) > HELD_EDGES:
                a, b = spanning_forest(a, b)
                if len(a) > HELD_EDGES // 2:
                    yield pd.DataFrame({"a": a, "b": b})
                    a, b = a[:0], b[:0]
        if len(a):
            a, b = spanning_forest(a, b)
        yield pd.DataFrame({"a": a, "b": b})

    return edges.mapInPandas(forest, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (a, b): the smallest node each one reaches.

    Nodes without an edge to another node do not occur. Edges may repeat; nulls are dropped.
    Alternating rounds: every node's larger neighbours move to its smallest neighbour (large star),
    then its smaller ones do (small star), until nothing changes and every component is a star.
    Minima are summed up in every task before the shuffle, and the join back can be split at a hot
    centre, as the minima are a written table.
    """
    workers.ready(edges.sparkSession)
    edges = stored(_local_forests(edges.filter("a <> b")).distinct())
    state, spent = None, []
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        spent = [edges, stored(both.groupBy("a").agg(F.min("b").alias("near")))]
        least = spent[-1].withColumn("low", F.least("a", "near")).select("a", "low")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), "low")
        large = stored(large.withColumnRenamed("low", "b").filter("a <> b").distinct())
        least = stored(large.groupBy("a").agg(F.min("b").alias("low")))
        spent += [large, least]
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
        edges = stored(small.unionByName(least.withColumnRenamed("low", "b")).distinct())
        discard(*spent)  # the new edges are written
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
