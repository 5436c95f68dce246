"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors

MOST_FUNCTIONS = 10  # a query weighs 3 ** functions buckets
PENDING = 1 << 21
RANGE = 1.25  # the norms of rows that are hashed together differ by this factor at most
FEW = 256  # rows that are scored exactly, as they are too few to hash
ROUNDS = (4, 16, 64, 256)  # probes of each table after which a query may be done
TOGETHER = 256  # queries that visit their buckets together
SLACK = 1e-9


class Hashes:
    """Tables of p-stable functions floor((a x + b) / width) over vectors of norm 1.

    Rows are divided by the largest norm of those hashed together and lifted to norm 1 by one more
    component, so that the nearest lifted rows are those of largest inner product; queries are
    scaled to norm 1, which leaves their order as it is.
    """

    def __init__(self, dims: int, tables: int, functions: int, width: float, seed: int):
        random = np.random.default_rng(seed)
        self.width = width
        self.axes = random.normal(size=(tables, dims + 1, functions))
        self.shift = random.uniform(0, self.width, size=(tables, 1, functions))
        self.odd = random.integers(1, 2**62, size=(tables, functions), dtype=np.int64) * 2 + 1
        steps = np.array(list(itertools.product((0, -1, 1), repeat=functions)), dtype=np.int64)
        self.offsets = [steps @ odd for odd in self.odd]  # key differences, modulo 2 ** 64
        self.functions = functions

    def lift(self, x: np.ndarray, norm: np.ndarray | float) -> np.ndarray:
        """`x` divided by `norm`, one number or one a row, and lifted."""
        x = x / norm
        more = np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, more[:, None]], axis=1)

    def place(self, lifted: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket keys, positions within the bucket in each function, 0 to 1)."""
        at = (lifted @ self.axes[table] + self.shift[table]) / self.width
        cell = np.floor(at)
        return cell.astype(np.int64) @ self.odd[table], at - cell

    def probes(
        self, lifted: np.ndarray, table: int, count: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, steps, positions): the `count` likeliest buckets of every query, likeliest first.

        A bucket one step away in some functions is the likelier to hold near rows, the smaller
        the sum of squared distances to the boundaries that those steps cross.
        """
        keys, inside = self.place(lifted, table)
        cost = np.zeros((len(lifted), 1), dtype=np.float32)
        for f in range(self.functions):
            x = inside[:, f : f + 1].astype(np.float32)
            step = np.concatenate([np.zeros_like(x), x * x, (1 - x) ** 2], axis=1)
            cost = (cost[:, :, None] + step[:, None, :]).reshape(len(lifted), -1)
        count = min(count, cost.shape[1])
        chosen = np.argpartition(cost, count - 1, axis=1)[:, :count]
        order = np.argsort(np.take_along_axis(cost, chosen, axis=1), axis=1)
        chosen = np.take_along_axis(chosen, order, axis=1)
        return keys[:, None] + self.offsets[table][chosen], chosen, inside

    def chance(self, inside: np.ndarray, chosen: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """How likely a row at a distance from each query lies in one of its `chosen` buckets: its
        projections differ from the query's by normal deviates of that size."""
        spread = np.maximum(distance / self.width, 1e-9)[:, None]

        def below(edge: int) -> np.ndarray:
            z = np.clip((edge - inside) / spread, -30, 30)
            return 1 / (1 + np.exp(-z * (1.5976 + 0.07056 * z * z)))  # normal, to 0.0002

        low, here, high, more = (below(edge) for edge in (-1, 0, 1, 2))
        each = np.stack([high - here, here - low, more - high], axis=2)  # steps 0, -1, 1
        found = np.ones(chosen.shape)
        for f in range(self.functions):
            step = chosen // 3 ** (self.functions - 1 - f) % 3
            found *= np.take_along_axis(each[:, f], step, axis=1)
        return found.sum(axis=1)


class Buckets:
    """The rows of one table by bucket."""

    def __init__(self, keys: np.ndarray):
        self.members = np.argsort(keys, kind="stable")
        self.keys, self.begin = np.unique(keys[self.members], return_index=True)
        self.size = np.diff(np.append(self.begin, len(keys)))

    def rows(self, visited: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line of `visited`, row) of every row in a visited bucket."""
        wanted = visited.ravel()
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == wanted)
        at = at[hit]
        size = self.size[at]
        first = np.repeat(self.begin[at] - np.cumsum(size) + size, size)
        return np.repeat(hit // visited.shape[1], size), self.members[first + np.arange(len(first))]


def _compact(parts: list[tuple], k: int, queries: int) -> tuple[tuple, np.ndarray]:
    """The k best distinct rows of every query, with all that tie within SLACK, and the k-th score."""
    q, r, s = (np.concatenate(column) for column in zip(*parts, strict=True))
    order = np.lexsort((r, q))
    q, r, s = q[order], r[order], s[order]
    first = np.ones(len(q), dtype=bool)
    first[1:] = (q[1:] != q[:-1]) | (r[1:] != r[:-1])
    q, r, s = q[first], r[first], s[first]
    order = np.lexsort((-s, q))
    q, r, s = q[order], r[order], s[order]
    starts = np.searchsorted(q, np.arange(queries + 1))
    least = np.full(queries, -np.inf)
    enough = np.flatnonzero(np.diff(starts) >= k)
    least[enough] = s[starts[enough] + k - 1]
    least -= SLACK * np.maximum(np.abs(least), 1, where=np.isfinite(least), out=np.ones(queries))
    keep = s >= least[q]
    return (q[keep], r[keep], s[keep]), least


def _norms(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def _ranges(norms: np.ndarray) -> Iterator[tuple[int, int, bool]]:
    """(begin, end, few) of the rows taken together, of norms in falling order."""
    begin = 0
    while begin < len(norms):
        end = int(np.searchsorted(-norms, -norms[begin] / RANGE, side="right"))
        few = end - begin <= FEW
        if few:
            end = min(begin + FEW, len(norms))
        yield begin, end, few
        begin = end


def _nearest_in_shard(
    k: int, probes: int, hashes: Hashes, miss: float, tally: list[int] | None = None
) -> vectors.Search:
    """The search of a query block in a shard; `tally` is told how many rows were scored."""

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        both = vectors.dense(pd.concat([queries.vector, rows.vector]))
        both = np.pad(both, ((0, 0), (0, hashes.axes.shape[1] - 1 - both.shape[1])))
        asked, held = both[: len(queries)], both[len(queries) :]
        lengths, norms = _norms(asked), _norms(held)
        lifted_queries = hashes.lift(asked, lengths[:, None])
        own = pd.Index(rows.vec_id).get_indexer(queries.vec_id)
        least = np.full(len(asked), -np.inf)
        none = np.array([], dtype=np.int64)
        found: list[tuple] = [(none, none, np.array([]))]
        pending = 0

        def compact() -> None:
            nonlocal found, least, pending
            kept, least = _compact(found, k, len(asked))
            found, pending = [kept], 0

        def score(asking: np.ndarray, inside: np.ndarray) -> None:
            nonlocal pending
            if tally is not None:
                tally.append(len(asking) * len(inside))
            score = asked[asking] @ held[inside].T
            i, j = np.nonzero(
                (score >= least[asking][:, None]) & (own[asking][:, None] != inside[None, :])
            )
            found.append((asking[i], inside[j], score[i, j]))
            pending += len(i)
            if pending > PENDING:
                compact()

        def score_all(asking: np.ndarray, inside: np.ndarray) -> None:
            for at in range(0, len(inside), FEW):
                score(asking, inside[at : at + FEW])

        def score_hashed(asking: np.ndarray, together: np.ndarray) -> None:
            norm = norms[together].max()
            lifted_rows = hashes.lift(held[together], norm)
            tables = [Buckets(hashes.place(lifted_rows, t)[0]) for t in range(len(hashes.axes))]
            for at in range(0, len(asking), TOGETHER):
                visit(asking[at : at + TOGETHER], together, norm, tables)

        def visit(asking: np.ndarray, together: np.ndarray, norm: float, tables: list) -> None:
            """Rounds of probes, in all tables; a row that several buckets hold is scored once."""
            order = [hashes.probes(lifted_queries[asking], t, probes) for t in range(len(tables))]
            seen = np.zeros((len(asking), len(together)), dtype=bool)
            active, start = np.arange(len(asking)), 0
            for stop in [*(r for r in ROUNDS if r < probes), probes]:
                before = seen[active]
                for buckets, (keys, _, _) in zip(tables, order, strict=True):
                    line, row = buckets.rows(keys[active, start:stop])
                    seen[active[line], row] = True
                for q, new in zip(asking[active], seen[active] & ~before, strict=True):
                    score(np.array([q]), together[new])
                compact()
                # as likely as this, a row that beats the k-th lies in no bucket visited so far
                near = least[asking[active]] / (lengths[asking[active]] * norm)
                distance = np.sqrt(np.maximum(2 - 2 * np.maximum(near, -1), 0))
                missed = np.ones(len(active))
                if stop < probes:
                    for _, steps, inside in order:
                        missed *= 1 - hashes.chance(inside[active], steps[active, :stop], distance)
                active, start = active[(missed > miss) | np.isinf(near)], stop

        falling = np.argsort(-norms, kind="stable")
        for begin, end, few in _ranges(norms[falling]):
            together = np.sort(falling[begin:end])
            # a row's score is at most the product of both norms
            best = lengths * norms[together].max()
            asking = np.flatnonzero(best + SLACK * np.maximum(best, 1) >= least)
            if len(asking):
                (score_all if few else score_hashed)(asking, together)
                compact()
        # queries whose probes found too few rows
        wanted = np.minimum(k, len(held) - (own >= 0))
        short = np.flatnonzero(np.bincount(found[0][0], minlength=len(asked)) < wanted)
        if len(short):
            score_all(short, np.arange(len(held)))
        compact()
        q, r, _ = found[0]
        # the same sum in the same order for equal vectors, so that ties are ties
        exact = (asked[q] * held[r]).sum(axis=1)
        best = pd.DataFrame(
            {
                "query_id": queries.vec_id.to_numpy()[q],
                "vec_id": rows.vec_id.to_numpy()[r],
                "score": exact,
            }
        ).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return best.groupby("query_id").head(k)

    return search


def nearest(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 20,
    tables: int = 4,
    functions: int = 8,
    width: float = 2.0,
    probes: int = 800,
    miss: float = 0.01,
    seed: int = 11,
    shard_rows: int = vectors.SHARD_ROWS,
    query_rows: int = vectors.QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product found for each query.

    Every row is hashed into `tables` tables of `functions` p-stable functions; a query visits its
    own bucket and the perturbed ones in the order of estimated success, up to `probes` in each table,
    and the union of their rows is ranked by the exact inner product in double precision, each row
    scored once. A query is done earlier once a row that beats its k-th lies in none of the buckets
    visited so far with a probability of at most `miss`, by the distance that such a row has. Rows are
    hashed by ranges of norm, with widths relative to the largest norm of a range, from large to
    small; a query leaves out ranges whose norms are too small for its k rows so far. Ranges of few
    rows are scored exactly, and so are all rows of a shard for a query that found fewer than k of
    them. No bucket is capped: rows are cut into shards by hash of their id, so a bucket that holds
    a third of all rows is spread over all shards.

    A row with the query's own id is no candidate. Ties go to the smaller vec_id; all candidates
    are returned, if fewer than k; repeated ids count once (the smallest vector); null ids and vectors
    that are null, empty, zero or hold null or non-finite components take no part; shorter vectors
    are read as ending in zeros. Empty frames give an empty result. Other columns are not read.
    """
    if not 1 <= functions <= MOST_FUNCTIONS:
        raise ValueError(f"functions must be 1 to {MOST_FUNCTIONS}")

    def nonzero(frame: DataFrame) -> DataFrame:
        kept = frame.filter(F.exists("vector", lambda x: x != 0))
        return vectors.partaking(
            kept.withColumn("vector", F.transform("vector", lambda x: x.cast("double")))
        )

    queries, rows = nonzero(queries), nonzero(rows)
    known = rows.agg(F.max(F.size("vector")).alias("dims")).first()
    asked = queries.agg(F.max(F.size("vector")).alias("dims")).first()
    dims = max(known["dims"] or 1, asked["dims"] or 1)
    hashes = Hashes(dims, tables, functions, width, seed)
    within = _nearest_in_shard(k, probes, hashes, miss)
    return vectors.search(queries, rows, k, within, "double", shard_rows, query_rows)
