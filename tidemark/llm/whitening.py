"""Embedding whitening: shifted CholeskyQR over the rows, then an SVD of the small factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import workers

STEPS = 1024  # an entry c becomes floor(STEPS * c) + LIFT
LIFT = 100_000
LARGEST = 1 << 40  # entries beyond stand at this size, so that sums of a batch fit in a long
COMPONENTS = 8
PASSES = 12
NEAR_IDENTITY = 1e-12


def remaining(rows: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows whose vector is not null and holds no null or non-finite entry."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.select("vec_id", "vector").filter(F.coalesce(~bad, F.lit(False)))


def quantised(column: pa.Array, width: int | None = None) -> np.ndarray:
    """One row of longs for every vector, floor(1024 c) + 100000; shorter vectors end in entries 0."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    cells = np.full(len(flat), LIFT, np.int64)
    bound = float(LARGEST)
    cells[:] = np.clip(np.floor(STEPS * np.clip(flat, -bound, bound)) + LIFT, -bound, bound)
    if len(flat) == len(lengths) * width:
        return cells.reshape(len(lengths), width)
    out = np.full((len(lengths), width), LIFT, np.int64)
    out[np.arange(width) < lengths[:, None]] = cells
    return out


@dataclass
class Moments:
    """Rows, width, and the exact sum of each dimension."""

    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        # whole part and remainder apart, so that the mean is right to the last bit at any n
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])


def moments(rows: DataFrame) -> Moments:
    """One pass: each task sums its rows, Spark adds the sums of a dimension. Shorter vectors count
    as ended by entries 0, whatever the width a task has seen."""

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, []
        for batch in batches:
            x = quantised(batch.column(0))
            found = [int(s) for s in (x - LIFT).sum(axis=0)] if len(x) else []
            sums += [0] * (len(found) - len(sums))
            for k, value in enumerate(found):
                sums[k] += value
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(-1, len(sums)), pa.int32()),
                    pa.array([str(v) for v in [n, *sums]], pa.string()),
                ],
                names=["dimension", "total"],
            )

    parts = rows.select("vector").mapInArrow(in_task, "dimension int, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = {r.dimension: int(r.total) for r in parts.groupBy("dimension").agg(total).collect()}
    n = found.pop(-1, 0)
    return Moments(n, [found[k] + n * LIFT for k in sorted(found)])


def _summed(rows: DataFrame, partial: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """Sum of the matrices that `partial` makes of batches: one a task, added row by row in Spark.

    What comes to the driver is one matrix, whose size depends on the width of the vectors alone.
    """

    @workers.lean
    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = partial(batch.column(0))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(total)), pa.int32()),
                    pa.array([line.tobytes() for line in total], pa.binary()),
                ],
                names=["line", "cells"],
            )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(frame.cells.iloc[0]) // 8)
        for cells in frame.cells:
            total += np.frombuffer(cells)
        return pd.DataFrame({"line": frame.line[:1], "cells": [total.tobytes()]})

    parts = rows.select("vector").mapInArrow(in_task, "line int, cells binary")
    lines = parts.groupBy("line").applyInPandas(add, "line int, cells binary").collect()
    return np.stack([np.frombuffer(r.cells) for r in sorted(lines, key=lambda r: r.line)])


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangular factor, by substitution from the left."""
    out = np.empty_like(rows)
    for k in range(rows.shape[1]):
        out[:, k] = (rows[:, k] - out[:, :k] @ factor[:k, k]) / factor[k, k]
    return out


def _root(gram: np.ndarray, n: int, shifted: bool) -> tuple[np.ndarray, bool]:
    """(Upper triangular factor, whether it is of the Gram matrix itself and not of a shifted one)."""
    d = len(gram)
    if not shifted and np.linalg.cond(gram) < 1e12:
        return np.linalg.cholesky(gram).T, True
    unit = np.finfo(float).eps / 2
    shift = 11 * (n * d + d * (d + 1)) * unit * np.trace(gram)
    shift = max(min(shift, 1e-3 * np.trace(gram) / d), 1e-10 * np.trace(gram) / d)
    return np.linalg.cholesky(gram + shift * np.eye(d)).T, False


def factor(rows: DataFrame, at: Moments) -> np.ndarray:
    """R with A'A = R'R for the centred rows A, without ever forming A'A at its full condition.

    Each pass solves the rows by the factors so far, sums the Gram matrix of what is left and takes
    its Cholesky factor: shifted at first and while the matrix is badly conditioned, as it stands
    afterwards, until the rows are orthonormal. Dimensions that depend on others leave a Gram matrix that stays
    singular; its symmetric root then ends the product.
    """
    mean, factors = at.mean, []

    def gram(vectors: pa.Array) -> np.ndarray:
        left = quantised(vectors, len(mean)) - mean
        for r in factors:
            left = solved(left, r)
        return left.T @ left

    product = np.eye(len(mean))
    for turn in range(PASSES):
        found = _summed(rows, gram)
        if not found.any():
            return found
        if turn and np.abs(found - np.eye(len(mean))).max() < NEAR_IDENTITY * at.n**0.5:
            break
        r, exact = _root(found, at.n, shifted=not turn)
        settled = turn > 1 and not exact and np.linalg.eigvalsh(found)[-1] < 1.5
        if settled or turn == PASSES - 1:
            values, axes = np.linalg.eigh(found)
            return (np.sqrt(np.maximum(values, 0))[:, None] * axes.T) @ product
        factors.append(r)
        product = r @ product
        if exact and turn > 1:
            break
    return product


@dataclass
class Whitening:
    """Components (columns of `axes`) by falling eigenvalue, and the shares of variance they explain."""

    at: Moments
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.at.mean) @ self.axes / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact at any size."""
        n, sums = self.at.n, self.at.sums
        largest = max([abs(s) for s in sums] + [1]) + n * int(np.abs(x).max(initial=1))
        if largest * largest * max(len(sums), 1) < 1 << 62:
            gap = n * x - np.array(sums, np.int64)
            return [int(v) for v in (gap * gap).sum(axis=1)]
        sums = np.array(sums, dtype=object)
        return [int(((n * line.astype(object) - sums) ** 2).sum()) for line in x]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of (vec_id, vector) rows; None if no direction has any variance."""
    at = moments(rows)
    if not at.n or not at.sums:
        return None
    _, singular, axes = np.linalg.svd(factor(rows, at))
    values = singular**2 / at.n
    if not values[0] > 0:
        return None
    rank = int((values > values[0] * len(values) * 1e-14).sum())
    k = min(components, rank)
    return Whitening(at, axes[:k].T, values[:k], values[:k] / values.sum())


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry, in absolute value, of the whitened rows' covariance minus the identity."""
    width, n = len(model.at.sums), model.at.n

    def products(vectors: pa.Array) -> np.ndarray:
        white = model.project(quantised(vectors, width))
        return np.concatenate([white.T @ white, white.sum(axis=0)[None]])

    found = _summed(rows, products)
    mean = found[-1] / n
    covariance = found[:-1] / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(mean))).max())


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of (vec_id, vector).

    All rows but those `remaining` drops are fitted and whitened, one result row for each of the
    first `components` components (from 1, by falling eigenvalue); the covariance has divisor n.
    Every pass is a scan with one small matrix a task; no vector is shuffled.

    Rows that repeat an id or a vector count and are returned each; a null vec_id stays null. A
    vector shorter than the longest, an empty one too, ends in entries 0. Components without
    variance are not returned, so equal rows or a single one give none. An empty table gives an
    empty result. `deviation` is decimal(38,0), as it outgrows a long at some 10^8 rows. Entries
    beyond 2^40 count as 2^40. Other columns are not read.
    """
    workers.ready(rows.sparkSession)
    kept = remaining(rows)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double,"
        " explained double, identity_error double"
    )
    model = fit(kept, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error, width, k = identity_error(kept, model), len(model.at.sums), len(model.values)

    @workers.lean
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(batch.column(1), width)
            size = len(x) * k
            exact = pa.array([str(v) for v in model.deviation(x)], pa.string())
            row = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, model.at.n)),
                    exact.cast(pa.decimal128(38, 0)).take(pa.array(row)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(size, error)),
                ],
                names=schema_names,
            )

    schema_names = [part.split()[0] for part in schema.split(", ")]
    return kept.mapInArrow(emit, schema)
