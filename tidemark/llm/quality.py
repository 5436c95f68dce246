"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic fit."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts, workers
from tidemark.session import stored

FOURIER = 512
RIDGE = 1e-3
BINS = 1024
LIMIT = 6.0  # standard deviations beyond which a statistic says no more

_BYTES = np.arange(256)
_CLASSES = {
    "small": (_BYTES >= 97) & (_BYTES <= 122),
    "large": (_BYTES >= 65) & (_BYTES <= 90),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "beyond": _BYTES >= 128,
    "blank": texts.BLANK,
    "line": _BYTES == 10,
    "stop": np.isin(_BYTES, [ord(c) for c in ".,;:"]),
    "shout": np.isin(_BYTES, [ord(c) for c in "!?"]),
    "mark": np.isin(_BYTES, [ord(c) for c in "#$%&*+<=>@^_`~"]),
    "bar": np.isin(_BYTES, [ord(c) for c in "|/\\"]),
    "bracket": np.isin(_BYTES, [ord(c) for c in "()[]{}\"'"]),
}
_SHARES = np.stack([m.astype(float) for m in _CLASSES.values()], axis=1)
STATISTICS = len(_CLASSES) + 13


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics for every text; an empty or null text has zeros."""
    content, offsets = texts.flat(column)
    out = np.zeros((len(column), STATISTICS))
    for first, last in texts.parts(offsets):
        base = offsets[first]
        part, own = content[base : offsets[last]], offsets[first : last + 1] - base
        hashes, starts, ends, at = texts.words(part, own)
        pairs = texts.ngrams(hashes, 2)
        lengths = (ends - starts).astype(float)
        opening = part[starts] if len(starts) else part[:0]
        capital = (opening >= 65) & (opening <= 90)
        closing = part[ends - 1] if len(ends) else part[:0]
        ended = np.isin(closing, [ord("."), ord("!"), ord("?")])
        for row in range(last - first):
            a, b = at[row], at[row + 1]
            if a == b:
                continue
            counts = np.bincount(part[own[row] : own[row + 1]], minlength=256)
            size = counts.sum()
            share = counts[counts > 0] / size
            words, times = np.unique(hashes[a:b], return_counts=True)
            n = b - a
            two = pairs[a : b - 1]
            lines = counts[10] + 1
            out[first + row] = [
                *(counts @ _SHARES / size),
                -(share * np.log(share)).sum(),
                np.log1p(n),
                np.log1p(n / lines),
                lengths[a:b].mean(),
                lengths[a:b].std(),
                np.log(lengths[a:b].max()),
                len(words) / n,
                times.max() / n,
                (times[times > 1].sum()) / n,
                (hashes[a + 1 : b] == hashes[a : b - 1]).mean() if n > 1 else 0.0,
                len(np.unique(two)) / (n - 1) if n > 1 else 1.0,
                capital[a:b].mean(),
                ended[a:b].mean(),
            ]
    return out


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics as little-endian doubles) of each row of (doc_id, text)."""

    @workers.lean
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["doc_id", "statistics"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        describe, f"doc_id {kind}, statistics binary"
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _summed(rows: DataFrame, partial) -> dict[int, np.ndarray]:
    """Sums over all rows of `partial(frame)`, a matrix: one in every task, then Spark adds them.

    Each row of the matrix is a group of its own, so the size of what comes to the driver is fixed.
    """

    @workers.lean
    def in_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                found = partial(frame)
                total = found if total is None else total + found
        if total is not None:
            values = [r.tobytes() for r in total]
            yield pd.DataFrame({"line": np.arange(len(total)), "values": values})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = _matrix(frame["values"]).sum(axis=0)
        return pd.DataFrame({"line": frame.line[:1], "values": [total.tobytes()]})

    parts = rows.mapInPandas(in_task, "line int, values binary")
    lines = parts.groupBy("line").applyInPandas(add, "line int, values binary").collect()
    return {r.line: np.frombuffer(r["values"], np.float64) for r in lines}


@dataclass
class Model:
    """Scores of statistics; without training rows of both kinds, every score is `prior`."""

    prior: float = 0.5
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    axes: np.ndarray | None = None
    phase: np.ndarray | None = None
    weights: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, rows: np.ndarray) -> np.ndarray:
        """cos(a x + b) with Gaussian a: inner products approximate a Gaussian kernel."""
        x = np.clip((rows - self.mean) / self.scale, -LIMIT, LIMIT)
        z = np.cos(x @ self.axes + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.prior)
        raw = self.raw(rows)
        # a little of the raw score keeps the order within a step of the isotonic fit
        order = np.clip((raw + 0.5) / 2, 0, 1)
        return np.clip(0.998 * np.interp(raw, *self.steps) + 0.002 * order, 0, 1)


def isotonic(positives: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Non-decreasing rates nearest to positives / totals by weighted squares (pooled neighbours)."""
    blocks: list[list[float]] = []  # positives, totals, bins
    for p, t in zip(positives, totals, strict=True):
        blocks.append([p, t, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p1, t1, n1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p1, blocks[-1][1] + t1, blocks[-1][2] + n1]
    return np.repeat([b[0] / b[1] for b in blocks], [int(b[2]) for b in blocks])


def fit(examples: DataFrame, seed: int = 5, fourier: int = FOURIER) -> Model:
    """Model of (statistics, quality) rows, quality from 0 to 1. All rows count, in three passes."""
    spread = _summed(
        examples,
        lambda f: np.stack(
            [
                (x := _matrix(f.statistics)).sum(axis=0),
                (x * x).sum(axis=0),
                np.full(x.shape[1], float(len(x))),
                np.full(x.shape[1], f.quality.sum()),
            ]
        ),
    )
    if not spread:
        return Model()
    count, positive = spread[2][0], spread[3][0]
    if positive in (0, count):
        return Model(prior=float(positive / count))
    mean = spread[0] / count
    scale = np.sqrt(np.maximum(spread[1] / count - mean**2, 0))
    random = np.random.default_rng(seed)
    model = Model(
        mean=mean,
        scale=np.where(scale > 1e-9, scale, 1.0),
        axes=random.normal(size=(len(mean), fourier)) / np.sqrt(len(mean)),
        phase=random.uniform(0, 2 * np.pi, size=fourier),
    )

    def normal_equations(frame: pd.DataFrame) -> np.ndarray:
        z = model.features(_matrix(frame.statistics))
        return z.T @ np.concatenate([z, frame.quality.to_numpy()[:, None]], axis=1)

    lines = _summed(examples, normal_equations)
    both = np.stack([lines[k] for k in range(fourier + 1)])
    ridge = RIDGE * count / fourier * np.eye(fourier + 1)
    ridge[-1, -1] = 0.0
    model.weights = np.linalg.solve(both[:, :-1] + ridge, both[:, -1])

    def histogram(frame: pd.DataFrame) -> np.ndarray:
        raw = np.clip((model.raw(_matrix(frame.statistics)) + 0.5) / 2, 0, 1)
        bins = np.minimum((raw * BINS).astype(int), BINS - 1)
        return np.stack(
            [
                np.bincount(bins, frame.quality, BINS),
                np.bincount(bins, minlength=BINS).astype(float),
            ]
        )

    lines = _summed(examples, histogram)
    held = np.flatnonzero(lines[1])
    centres = (held + 0.5) / BINS * 2 - 0.5
    model.steps = centres, isotonic(lines[0][held], lines[1][held])
    return model


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves `part` when divided by `parts` (null id: as '')."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % parts == part


def _fitted(docs: DataFrame, labels: DataFrame, seed: int) -> tuple[DataFrame, Model]:
    """The table of statistics, with held_out, and the model of its labelled rows."""
    workers.ready(docs.sparkSession)
    rows = stored(described(docs))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    known = labels.filter("quality is not null").groupBy("doc_id")
    known = known.agg(F.avg(F.col("quality").cast("double")).alias("quality"))
    examples = rows.filter("not held_out").join(known, "doc_id").select("statistics", "quality")
    return rows, fit(stored(examples), seed)


def scored(docs: DataFrame, labels: DataFrame, seed: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of (doc_id, text).

    `labels` holds (doc_id, quality); rows without a quality are not used, and several labels of a
    document are averaged. The model is fitted on the labelled documents that are not held out
    (crc32(doc_id) mod 3 is not 1); what it sees are statistics of the whole text only. One scan of
    the texts; everything else reads the table of statistics.

    A null or empty text has all statistics 0 and is scored like any other; repeated rows are scored
    alike. Null doc_ids have no label. Without labels of both kinds every score is their mean, or 0.5.
    An empty table gives an empty result; other columns are not read.
    """
    rows, model = _fitted(docs, labels, seed)

    @workers.lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(_matrix(batch.column(2).to_pylist())) if len(batch) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(found, pa.float64()),
                    pa.array((found >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "held_out", "statistics").mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def accepted(docs: DataFrame, labels: DataFrame, seed: int = 5) -> DataFrame:
    """The rows of `docs` that score 0.5 or more (see scored); all their columns.

    The rows are scored where they are read, so nothing is joined by id.
    """
    _, model = _fitted(docs, labels, seed)
    place = docs.columns.index("text")

    @workers.lean
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = model.score(statistics(batch.column(place))) >= 0.5
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
