"""Language ID: a bidirectional gated recurrent network over bytes, trained here by backpropagation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import texts, workers
from tidemark.llm.quality import held_out
from tidemark.session import stored

UNKNOWN = "und"
SEGMENT = 64  # bytes read in one go, from a state of zeros
BATCH = 4096
HIDDEN = 12
DOCS_PER_LANGUAGE = 256  # rows the network is fitted on, and segments of each of them
SEGMENTS_PER_DOC = 16
STEPS, STEP_ROWS, RATE = 400, 512, 0.01


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Direction:
    """One gated recurrent layer: update gate z, reset gate r and candidate c for each byte."""

    def __init__(self, random: np.random.Generator, hidden: int):
        self.bytes = random.normal(0, 0.3, (3, 256, hidden)).astype(np.float32)  # z, r, c
        self.back = random.normal(0, 1 / np.sqrt(hidden), (3, hidden, hidden)).astype(np.float32)

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """z, r, c, the candidate's recurrent part, and the next state."""
        given = np.stack([np.take(t, x, axis=0) for t in self.bytes])
        past = np.matmul(h, self.back)
        gates = _sigmoid(given[:2] + past[:2])
        c = np.tanh(given[2] + gates[1] * past[2])
        return gates[0], gates[1], c, past[2], h + gates[0] * (c - h)

    def states(self, x: np.ndarray, mask: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """State after each row of x [time, segment]; where the mask is 0, it stays at zero."""
        h = np.zeros((x.shape[1], self.back.shape[1]), np.float32)
        given = np.empty((3, *h.shape), np.float32)
        past = np.empty_like(given)
        for t, now in enumerate(x):
            for k in range(3):
                np.take(self.bytes[k], now, axis=0, out=given[k], mode="clip")
            np.matmul(h, self.back, out=past)
            gates, c = given[:2], given[2]
            gates += past[:2]
            _sigmoid(gates)
            past[2] *= gates[1]
            c += past[2]
            np.tanh(c, out=c)
            c -= h
            c *= gates[0]
            h += c
            if mask is not None:
                h *= mask[t][:, None]
            yield h

    def learn(self, x: np.ndarray, kept: list[tuple], errors: np.ndarray) -> list[np.ndarray]:
        """Gradients of bytes and back, from the errors of the states (backpropagation in time)."""
        pre = np.empty((3, *errors.shape), np.float32)
        back = np.zeros_like(self.back)
        following = np.zeros_like(errors[0])
        for t in range(len(x) - 1, -1, -1):
            before, z, r, c, past = kept[t]
            dh = errors[t] + following
            dc = dh * z * (1 - c * c)
            dr = dc * past * r * (1 - r)
            dz = dh * (c - before) * z * (1 - z)
            pre[0, t], pre[1, t], pre[2, t] = dz, dr, dc
            into = np.stack([dz, dr, dc * r])
            back += before.T @ into
            following = dh * (1 - z) + np.matmul(into, self.back.transpose(0, 2, 1)).sum(axis=0)
        flat, hidden = x.ravel(), errors.shape[-1]
        table = np.empty_like(self.bytes)
        for k in range(3):
            rows = pre[k].reshape(-1, hidden)
            for h in range(hidden):
                table[k, :, h] = np.bincount(flat, rows[:, h], 256)
        return [table, back]


@dataclass
class Network:
    """Labels every byte with probabilities of the languages."""

    languages: list[str]
    forward: Direction
    backward: Direction
    out: list[np.ndarray] = field(default_factory=list)  # of forward and backward states, bias

    def summed(self, x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """Sum over the positions of each segment of the probabilities of every language."""
        total = np.zeros((x.shape[1], len(self.languages)), np.float32)
        one = np.ones((len(self.languages), 1), np.float32)
        ahead = [h @ self.out[0] + self.out[2] for h in self.forward.states(x, mask)]
        behind = self.backward.states(x[::-1], None if mask is None else mask[::-1])
        for back, (logits, h) in enumerate(zip(reversed(ahead), behind, strict=True)):
            logits += h @ self.out[1]
            np.exp(logits, out=logits)
            logits /= logits @ one
            if mask is not None:
                logits *= mask[len(x) - 1 - back][:, None]
            total += logits
        return total

    def pooled(self, content: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over all bytes of each text (zeros for an empty one)."""
        sizes = np.diff(offsets)
        pieces = -(-sizes // SEGMENT)
        text = np.repeat(np.arange(len(sizes)), pieces)
        within = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[text] + within * SEGMENT
        length = np.minimum(offsets[text + 1] - start, SEGMENT)
        padded = np.concatenate([content, np.zeros(SEGMENT, np.uint8)])
        total = np.zeros((len(sizes), len(self.languages)))
        for full in (True, False):
            chosen = np.flatnonzero((length == SEGMENT) == full)
            for at in range(0, len(chosen), BATCH):
                rows = chosen[at : at + BATCH]
                time = np.arange(SEGMENT)[:, None]
                x = padded[start[rows][None, :] + time]
                mask = None if full else (time < length[rows][None, :]).astype(np.float32)
                np.add.at(total, text[rows], self.summed(x, mask))
        return total / np.maximum(sizes, 1)[:, None]


def train(
    segments: np.ndarray, targets: np.ndarray, languages: list[str], seed: int = 3, steps: int = STEPS
) -> Network:
    """Network fitted to segments [segment, byte] of known languages, by Adam on random batches.

    The loss is the cross-entropy of every position's label with the language of its document.
    """
    random = np.random.default_rng(seed)
    net = Network(languages, Direction(random, HIDDEN), Direction(random, HIDDEN))
    shape = (HIDDEN, len(languages))
    net.out = [random.normal(0, 0.3, shape).astype(np.float32) for _ in range(2)]
    net.out.append(np.zeros(len(languages), np.float32))
    weights = [net.forward.bytes, net.forward.back, net.backward.bytes, net.backward.back, *net.out]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        rows = random.integers(0, len(segments), STEP_ROWS)
        x, wanted = segments[rows].T, targets[rows]
        kept, states = [], []
        for layer, seen in ((net.forward, x), (net.backward, x[::-1])):
            h, trace, after = np.zeros((STEP_ROWS, HIDDEN), np.float32), [], []
            for now in seen:
                z, r, c, past, new = layer.step(now, h)
                trace.append((h, z, r, c, past))
                after.append(new)
                h = new
            kept.append(trace)
            states.append(np.stack(after))
        ahead, behind = states[0], states[1][::-1]
        logits = ahead @ net.out[0] + behind @ net.out[1] + net.out[2]
        error = np.exp(logits - logits.max(axis=2, keepdims=True))
        error /= error.sum(axis=2, keepdims=True)
        error[:, np.arange(STEP_ROWS), wanted] -= 1
        error /= error.shape[0] * error.shape[1]
        flat = error.reshape(-1, len(languages))
        gradients = [
            *net.forward.learn(x, kept[0], error @ net.out[0].T),
            *net.backward.learn(x[::-1], kept[1], (error @ net.out[1].T)[::-1]),
            ahead.reshape(-1, HIDDEN).T @ flat,
            behind.reshape(-1, HIDDEN).T @ flat,
            flat.sum(axis=0),
        ]
        pace = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(weights, gradients, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _has_letter(content: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    low = content | 32
    seen = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
    found = seen[offsets[1:]] > seen[offsets[:-1]]
    for k in np.flatnonzero(~found):
        part = content[offsets[k] : offsets[k + 1]]
        if (part >= 128).any():
            found[k] = any(map(str.isalpha, part.tobytes().decode("utf-8", "ignore")))
    return found


def examples(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> list:
    """(lang, segment) rows of at most `per_language` documents of each language.

    Documents are taken by the hash of their id, among those not held out (crc32(doc_id) mod 5 is
    not 0) with a language and a text; of each, SEGMENTS_PER_DOC segments spread over its whole text.
    Rows that repeat an id in a language are one document, that of the smallest text hash, then text,
    so however often an id repeats, the bound holds.
    """
    rows = docs.select("doc_id", "text", "lang").filter(
        "lang is not null and length(text) > 0 and doc_id is not null"
    )
    rows = rows.filter(~held_out(F.col("doc_id"), 5, 0))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    drawn = rows.groupBy("doc_id", "lang").agg(F.min("hash").alias("hash"))
    drawn = drawn.withColumn("draw", F.xxhash64("doc_id", F.lit("langid")))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    drawn = drawn.withColumn("turn", F.row_number().over(order))
    drawn = stored(drawn.filter(F.col("turn") <= per_language).select("doc_id", "lang", "hash"))

    @workers.lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                last = max(len(raw) - SEGMENT, 0)
                for at in sorted({round(x) for x in np.linspace(0, last, SEGMENTS_PER_DOC)}):
                    langs.append(lang)
                    parts.append(raw[at : at + SEGMENT].ljust(SEGMENT, b" "))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(parts, pa.binary())],
                names=["lang", "segment"],
            )

    # at most per_language rows a language, so the texts that meet in the shuffle are few
    chosen = rows.join(F.broadcast(drawn), ["doc_id", "lang", "hash"], "left_semi")
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")
    found = chosen.mapInArrow(cut, "lang string, segment binary").collect()
    return sorted((r.lang, bytes(r.segment)) for r in found)


def fit(docs: DataFrame, seed: int = 3) -> Network | None:
    """Network for the languages of `docs`; None if there is nothing to learn from."""
    rows = examples(docs)
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    segments = np.frombuffer(b"".join(s for _, s in rows), np.uint8).reshape(-1, SEGMENT)
    targets = np.array([languages.index(lang) for lang, _ in rows])
    return train(segments, targets, languages, seed)


def predicted(docs: DataFrame, seed: int = 3) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of (doc_id, text, lang).

    The network reads every byte of every text, forwards and backwards in segments of SEGMENT bytes,
    gives each position probabilities of the languages, and pools them over the text: lang_pred is
    the language of the largest mean, score that mean. It is fitted on the driver to the bounded
    sample of `examples`; the driver holds about 16 KB a document of it at most.

    A text that is null or has no letter gets `und` and 0, and so does every text if there is nothing
    to learn from. Repeated rows are treated alike; ties go to the language first in order. An empty
    table gives an empty result; columns other than doc_id, text and lang are not read.
    """
    workers.ready(docs.sparkSession)
    net = fit(docs, seed)

    @workers.lean
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, offsets = texts.flat(batch.column(1))
            languages: list[str] = []
            scores: list[float] = []
            for a, b in texts.parts(offsets):
                base = offsets[a]
                part, own = content[base : offsets[b]], offsets[a : b + 1] - base
                letters = _has_letter(part, own)
                if net is None:
                    letters[:] = False
                    means = np.zeros((b - a, 1))
                else:
                    means = net.pooled(part, own)
                best = means.argmax(axis=1)
                for row, (known, k) in enumerate(zip(letters, best, strict=True)):
                    languages.append(net.languages[k] if known else UNKNOWN)
                    scores.append(min(float(means[row, k]), 1.0) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double"
    )
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")
