"""Exact top-k inner products by MaxScore over signed impact lists, shard by shard."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.session import stored

EXACT = 2.0**53  # products below this are exact in double precision
BLOCK_ROWS = 2048  # rows between two looks at the threshold
PROBES = 4  # non-essential terms probed between two looks at the bounds left
LEADERS = 8  # strongest terms, and rows of each list, that give the first threshold


class Postings:
    """Signed impact lists of a shard: a term is a component with a sign, its list the rows that have
    a component of that sign, by row number."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.weights = ids[order], weights[order]
        self.has = np.stack([self.weights > 0, self.weights < 0]).transpose(0, 2, 1).copy()
        parts = (np.maximum(self.weights, 0), np.maximum(-self.weights, 0))
        self.most = np.stack([p.max(axis=0, initial=0) for p in parts])
        lead = min(LEADERS, len(ids))
        self.leaders = [np.argpartition(-p, lead - 1, axis=0)[:lead] for p in parts] if lead else []

    def top(
        self, query_id: int, query: np.ndarray, k: int, least: float = -math.inf
    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows of at least `least`, best first, ties to the smaller id.

        Every component adds |q| times the impact list of the query's sign and takes off as much of
        the opposite one. The lists that add are the terms, by falling bound. Terms whose bounds add
        up to less than the threshold are non-essential: no row reaches it by them alone. Only rows
        found in essential postings are scored, and of these only the ones that the bounds left can
        still lift to the threshold are probed in the other terms. Rows go by in blocks; each raises
        the threshold, which moves the border for the next.
        """
        terms = np.flatnonzero(query)
        signs = (query[terms] < 0).astype(int)
        bounds = np.abs(query[terms]) * self.most[signs, terms]
        order = np.argsort(-bounds, kind="stable")
        terms, signs, bounds = terms[order], signs[order], bounds[order]
        rest = np.append(np.cumsum(bounds[::-1])[::-1], 0.0)  # rest[n]: what terms n.. add at most
        least = max(least, self._seeded(query_id, query, k, terms, signs))
        best, scores = np.zeros(0, int), np.zeros(0)
        for start in range(0, len(self.ids), BLOCK_ROWS):
            # the first terms, as many as leave less than the threshold to the rest
            border = int(np.searchsorted(-rest, -least, side="right"))
            rows = self._candidates(start, terms, signs, border)
            rows = rows[self.ids[rows] != query_id]
            score = self._partial(rows, query, terms[:border])
            for n in range(border, len(terms), PROBES):
                within = score + rest[n] >= least
                rows, score = rows[within], score[within]
                score += self._partial(rows, query, terms[n : n + PROBES])
            within = score >= least
            best, scores = np.append(best, rows[within]), np.append(scores, score[within])
            order = np.lexsort((self.ids[best], -scores))[:k]
            best, scores = best[order], scores[order]
            if len(best) == k:
                least = max(least, scores[-1])
        return self.ids[best], scores

    def _candidates(self, start: int, terms, signs, border: int) -> np.ndarray:
        """Rows of a block with a posting of an essential term; all, if no term is needed."""
        stop = min(start + BLOCK_ROWS, len(self.ids))
        if border > len(terms):
            return np.arange(start, stop)
        found = np.zeros(stop - start, bool)
        for sign, term in zip(signs[:border], terms[:border], strict=True):
            found |= self.has[sign, term, start:stop]
        return start + np.flatnonzero(found)

    def _partial(self, rows: np.ndarray, query: np.ndarray, terms: np.ndarray) -> np.ndarray:
        return self.weights[np.ix_(rows, terms)] @ query[terms]

    def _seeded(self, query_id: int, query: np.ndarray, k: int, terms, signs) -> float:
        """A first threshold: the k-th score of rows that lead the lists of the strongest terms."""
        if not len(terms) or not len(self.ids):
            return -math.inf
        lists = [self.leaders[s][:, c] for s, c in zip(signs[:LEADERS], terms[:LEADERS], strict=True)]
        seeds = np.unique(np.concatenate(lists))
        seeds = seeds[self.ids[seeds] != query_id]
        known = np.sort(self.weights[seeds] @ query)[::-1]
        return known[k - 1] if len(known) >= k else -math.inf


def _exactly(rows: np.ndarray, ids: np.ndarray, query_id: int, query: np.ndarray, k: int):
    """The same answer in whole numbers of any size, for weights too large for doubles."""
    whole = [int(q) for q in query]
    found = sorted(
        (-sum(int(w) * q for w, q in zip(row, whole, strict=True)), int(i))
        for i, row in zip(ids, rows, strict=True)
        if i != query_id
    )[:k]
    return [i for _, i in found], [min(max(-s, -(2**63)), 2**63 - 1) for s, _ in found]


def _best_in_shard(k: int) -> vectors.Search:
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        both = vectors.dense(pd.concat([queries.vector, rows.vector]))
        asked, held = both[: len(queries)], both[len(queries) :]
        ids = rows.vec_id.to_numpy()
        limit = np.abs(asked).max() * np.abs(held).max() * both.shape[1]
        postings = Postings(ids, held) if limit < EXACT else None
        for query_id, query, least in zip(queries.vec_id, asked, queries.least, strict=True):
            if postings:
                best = postings.top(query_id, query, k, least)
            else:
                best = _exactly(held, ids, query_id, query, k)
            found += [(query_id, int(i), int(s)) for i, s in zip(*best, strict=True)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def top_k(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 5,
    shard_rows: int = vectors.SHARD_ROWS,
    query_rows: int = vectors.QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product for every query.

    Both frames hold (vec_id, vector) with whole-number components. A row with the query's own id
    is no candidate. Ties go to the smaller vec_id; fewer than k candidates are all returned;
    repeated ids count once (the smallest vector); null ids and vectors that are null, empty or
    hold null or non-finite components take no part; shorter vectors are read as ending in zeros.
    A score beyond 64 bits is shown as the last one that fits. Empty frames give an empty result.
    Other columns are not read.

    Rows are cut into shards and queries into blocks by hash, both of bounded size; every block
    meets every shard once, which yields k rows a query, and the shards' lists are merged by score.
    The first shard is searched ahead of all: its k-th score is where a query's threshold starts in
    every shard, so the others return only rows that may be among the k best of all.
    """
    asked, held = vectors.partaking(queries), vectors.partaking(rows)
    unbounded = asked.withColumn("least", F.lit(-math.inf))

    def found(some: DataFrame, among: DataFrame) -> DataFrame:
        return vectors.search(some, among, k, _best_in_shard(k), "long", shard_rows, query_rows)

    shards = vectors.pieces(held, shard_rows)
    if shards > 1:
        first = found(unbounded, held.filter(vectors.dealt(shards) == 0)).filter(F.col("rank") == k)
        least = F.col("score").cast("double").alias("least")
        reached = stored(first.select(F.col("query_id").alias("vec_id"), least))
        asked = asked.join(reached, "vec_id", "left").fillna(-math.inf, ["least"])
        # both sides stem from one frame, so the columns get new identities
        return found(asked.toDF(*asked.columns), held)
    return found(unbounded, held)


def quantised(embeddings: DataFrame, levels: float = 256.0) -> DataFrame:
    """(vec_id, vector) with every component x turned into floor(levels * x), x as double.

    Vectors that take no part are passed on as they are; `top_k` leaves them out.
    """
    scaled = F.transform(
        "embedding", lambda x: F.floor(F.lit(levels) * x.cast("double")).cast("double")
    )
    vector = F.when(vectors.usable(F.col("embedding")), scaled)
    return embeddings.select("vec_id", vector.alias("vector"))
