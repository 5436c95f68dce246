"""Secret scans: fixed patterns, and random-looking tokens by a battery of randomness tests."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts, workers

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
# What `=` cuts a token into, with the padding at its end, and what other marks cut that into.
VALUE, PART = re.compile("[^=]+(?:=+$)?"), re.compile("[^/_-]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
BINS = 50
ENOUGH = 50  # tokens by which a band is judged without its neighbours
REMEMBERED = 1 << 18  # tokens whose copies a task drops itself
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)

DIGITS, SMALL, LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets from narrow to wide, each with the classes of which a token must hold all.
ENCODINGS: dict[str, tuple[str, tuple[str, ...]]] = {
    "hex": (DIGITS + "abcdef", (DIGITS, "abcdef")),
    "HEX": (DIGITS + "ABCDEF", (DIGITS, "ABCDEF")),
    "base32": (LARGE + "234567", (LARGE, "234567")),
    "base36": (DIGITS + SMALL, (DIGITS, SMALL)),
    "base64": (LARGE + SMALL + DIGITS + "+/", (LARGE, SMALL, DIGITS)),
    "base64url": (LARGE + SMALL + DIGITS + "-_", (LARGE, SMALL, DIGITS)),
}


def _members(letters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in letters]] = True
    return table


TOKEN = _members(DIGITS + SMALL + LARGE + "+/_=-")
HEXADECIMAL = _members(DIGITS + "abcdef")


def encoding(token: str) -> tuple[str, list[int]] | None:
    """The narrowest encoding whose alphabet holds the token, and the token's symbol numbers."""
    held = set(token)
    for name, (alphabet, classes) in ENCODINGS.items():
        if held <= set(alphabet) and all(held & set(c) for c in classes):
            return name, [alphabet.index(c) for c in token]
    return None


def battery(symbols: list[int], k: int) -> float:
    """Probability of symbols as uneven, patterned or correlated as these if drawn at random.

    Chi-squared uniformity over the alphabet (by its exact mean and variance, as tokens are shorter
    than alphabets), runs above and below the middle, and lag-1 serial correlation, combined by
    Fisher's method.
    """
    n, x = len(symbols), np.array(symbols)
    counts = np.bincount(x, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    z = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    high = x >= k / 2
    above = int(high.sum())
    below = n - above
    if above and below and n > 2:
        both = 2 * above * below
        spread = both * (both - n) / (n * n * (n - 1))
        crossings = 1 + int((high[1:] != high[:-1]).sum())
        z = (crossings - both / n - 1) / math.sqrt(spread) if spread > 0 else 0.0
        alternation = math.erfc(abs(z) / math.sqrt(2))
    else:
        alternation = 2 * 0.5**n
    centred = x - (k - 1) / 2
    r = float((centred[1:] * centred[:-1]).sum()) / ((k * k - 1) / 12)
    serial = math.erfc(abs(r) / math.sqrt(n - 1) / math.sqrt(2))
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, alternation, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def candidates(token: str, least: int) -> Iterator[list[tuple[int, str, tuple[str, int, float]]]]:
    """What of a token may be a secret: lists of (offset, text, candidate), the longest first.

    A name and a value joined by `=` are two; marks at the end are padding and stay. Of each, the
    whole comes first, if an encoding holds it, then the parts that `/`, `_` and `-` join, as in
    addresses, paths and prefixed keys.
    """
    for piece in VALUE.finditer(token):
        found = []
        whole = candidate(piece[0]) if len(piece[0]) >= least else None
        if whole:
            found.append((piece.start(), piece[0], whole))
        for part in PART.finditer(piece[0]):
            if least <= len(part[0]) < len(piece[0]) and (tested := candidate(part[0])):
                found.append((piece.start() + part.start(), part[0], tested))
        if found:
            yield found


def length_band(n: int) -> int:
    """Half powers of two, so the bands are few whatever the lengths."""
    return int(2 * math.log2(n))


def candidate(token: str) -> tuple[str, int, float] | None:
    """(encoding, length band, probability under randomness); None without a known encoding."""
    body = token.rstrip("=")
    found = encoding(body)
    if found is None:
        return None
    name, symbols = found
    return name, length_band(len(body)), battery(symbols, len(ENCODINGS[name][0]))


def _pooled(
    counts: dict[tuple[str, int], np.ndarray], key: tuple[str, int]
) -> np.ndarray:
    """The histogram of a band; one of few tokens is joined by the nearest bands of its encoding
    and, should these not do, by all others."""

    def distance(other: tuple[str, int]) -> float:
        return abs(other[1] - key[1]) if other[0] == key[0] else math.inf

    pool = np.zeros(BINS)
    for _, ring in itertools.groupby(sorted(counts, key=distance), distance):
        pool += sum(counts[other] for other in ring)
        if pool.sum() >= ENOUGH:
            break
    return pool


def cutoffs(
    counts: dict[tuple[str, int], np.ndarray], rate: float = 0.05, least: float = 0.02
) -> dict[tuple[str, int], float]:
    """The least probability that still counts as random, per encoding and length band.

    Random tokens spread evenly over [0, 1]; others gather near 0, the closer the longer they are.
    So the upper half of a band's histogram tells how many of its tokens are random, and the cut-off
    is the lowest at which the tokens above it exceed their random share by no more than `rate` of
    them (or by no more than two standard deviations, where a band has few). Where the upper half is
    empty but as many random tokens as lie above `least` would leave it so with a probability of
    `rate` or more, the cut-off is `rate`. Bands of few tokens are judged with their neighbours.
    """
    found = {}
    for key in counts:
        histogram = _pooled(counts, key)
        random_per_bin = histogram[BINS // 2 :].sum() / (BINS / 2)
        if not random_per_bin and 0.5 ** histogram[round(least * BINS) :].sum() >= rate:
            found[key] = max(rate, least)
            continue
        kept, bins = 0.0, BINS
        best = 1.0
        for bins in range(BINS - 1, -1, -1):
            kept += histogram[bins]
            excess = kept - random_per_bin * (BINS - bins)
            if excess <= max(rate * kept, 2 * math.sqrt(random_per_bin * (BINS - bins))):
                best = bins / BINS
        found[key] = max(best, least)
    return found


def _long_tokens(
    column: pa.Array, member: np.ndarray, least: int
) -> Iterator[tuple[int, int, int, str]]:
    """(row, start, end, token) of every maximal run of `member` bytes, in code points."""
    content, offsets = texts.flat(column)
    for first, last in texts.parts(offsets):
        base, own = offsets[first], offsets[first : last + 1] - offsets[first]
        part = content[base : offsets[last]]
        starts, ends = texts.runs(member[part], own[:-1], least)
        rows = np.searchsorted(own, starts, side="right") - 1
        for row, start, end in zip(rows, starts, ends, strict=True):
            before = part[own[row] : start]
            at = len(before) - int(((before & 0xC0) == 0x80).sum())
            token = part[start:end].tobytes().decode("ascii")
            yield first + int(row), at, at + len(token), token


def spans_of(
    column: pa.Array, limits: dict[tuple[str, int], float], least: int
) -> list[list[tuple[str, int, int]]]:
    """All spans of every text, by start and then by kind; random ones only beside base ones."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in range(len(column))]
    for row, start, end, _ in _long_tokens(column, HEXADECIMAL, HEX_LENGTH):
        found[row].append(("hex", start, end))
    for row, scalar in enumerate(column):
        text = scalar.as_py() or ""
        if "=" in text or ":" in text:
            for m in ASSIGN.finditer(text):
                if len(m[2]) >= ASSIGN_LENGTH:
                    found[row].append(("assign", *m.span()))
        if "AKIA" in text:
            for m in ACCESS.finditer(text):
                if len(m[0]) >= ACCESS_LENGTH:
                    found[row].append(("access", *m.span()))
    base = [[(start, end) for _, start, end in spans] for spans in found]
    for row, start, end, token in _long_tokens(column, TOKEN, least):
        for choices in candidates(token, least):
            taken = -1
            for offset, text, tested in choices:
                first, last = start + offset, start + offset + len(text)
                if last <= taken or any(s < last and first < e for s, e in base[row]):
                    continue
                if tested[2] >= limits.get(tested[:2], 1.0):
                    found[row].append(("random", first, last))
                    taken = last
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in found]


def randomness_histogram(docs: DataFrame, least: int = 20) -> DataFrame:
    """(encoding, band, bin, tokens) over all distinct candidate tokens of all texts.

    Copies of a token, by its 64-bit hash, count once: they say nothing more of how many tokens are
    random. Each task drops most of its copies, Spark the others.
    """

    workers.ready(docs.sparkSession)
    types = {"token": pa.int64(), "encoding": pa.string(), "band": pa.int32(), "bin": pa.int32()}

    @workers.lean
    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            rows = []
            for _, _, _, token in _long_tokens(batch.column(0), TOKEN, least):
                if token in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(token)
                for _, text, found in (one for choices in candidates(token, least) for one in choices):
                    digest = hashlib.blake2b(text.rstrip("=").encode(), digest_size=8).digest()
                    name = int.from_bytes(digest, "little", signed=True)
                    rows.append((name, *found[:2], min(int(found[2] * BINS), BINS - 1)))
            columns = zip(*rows, strict=True) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types)
            )

    found = docs.select("text").mapInArrow(tested, "token long, encoding string, band int, bin int")
    return found.distinct().groupBy("encoding", "band", "bin").agg(F.count("*").alias("tokens"))


def fitted_cutoffs(
    docs: DataFrame, rate: float = 0.05, least: int = 20
) -> dict[tuple[str, int], float]:
    """Cut-offs from all texts; the histogram has at most encodings x bands x bins rows."""
    counts: dict[tuple[str, int], np.ndarray] = {}
    for row in randomness_histogram(docs, least).collect():
        histogram = counts.setdefault((row.encoding, row.band), np.zeros(BINS))
        histogram[row.bin] = row.tokens
    return cutoffs(counts, rate)


def find(docs: DataFrame, rate: float = 0.05, least: int = 20) -> DataFrame:
    """(doc_id, spans) of each row: array of (kind, start, end), code points, end exclusive.

    Kinds are those of the fixed patterns and `random`: tokens of at least `least` characters, values
    behind a `=`, or parts of them (see candidates) that fit an encoding, overlap no fixed pattern
    and pass the battery at the cut-off of their encoding and length band. Two scans, no shuffle but of the hashes of candidates.

    A null or empty text has no spans. Repeated rows are treated alike (and counted as often as
    they occur); spans that start together go by kind. An empty table gives an empty result.
    Columns other than doc_id and text are not read.
    """
    limits = fitted_cutoffs(docs, rate, least)

    @workers.lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = spans_of(batch.column(1), limits, least)
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, _ARROW_SPANS)], names=["doc_id", "spans"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, spans {SPANS}")


def redact(
    docs: DataFrame, mark: str = "[secret]", rate: float = 0.05, least: int = 20
) -> DataFrame:
    """`docs` with every span of `find` replaced by `mark` (overlapping spans by one)."""
    limits = fitted_cutoffs(docs, rate, least)
    place = docs.columns.index("text")

    def clean(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
        if not spans:
            return text
        kept, at = [], 0
        for _, start, end in spans:
            if start >= at:
                kept += [text[at:start], mark]
            at = max(at, end)
        return "".join(kept) + text[at:]

    @workers.lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            spans = spans_of(column, limits, least)
            if any(spans):
                rows = zip(column.to_pylist(), spans, strict=True)
                cleaned = pa.array([clean(*row) for row in rows], column.type)
                batch = batch.set_column(place, batch.schema.field(place), cleaned)
            yield batch

    return docs.mapInArrow(scan, docs.schema)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != "random")


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
