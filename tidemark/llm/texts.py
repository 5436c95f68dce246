"""Arrow text columns as flat byte arrays, a bounded part at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 4 << 20

# Whether a byte is one of space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; text i is bytes[offsets[i]:offsets[i + 1]], null empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset :][: len(column) + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(offsets: np.ndarray, size: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `size` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def runs(member: np.ndarray, breaks: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of True of at least `least` items that `breaks` do not cut."""
    edge = np.zeros(len(member) + 1, dtype=bool)
    if len(member):
        edge[0] = edge[-1] = True
        edge[1:-1] = member[1:] != member[:-1]
        edge[breaks] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    long = (ends - starts >= least) & member[starts] if len(at) else np.zeros(0, bool)
    return starts[long], ends[long]


def groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the stretches of equal values."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    begin = np.flatnonzero(new)
    return begin, np.append(begin[1:], len(values))[: len(begin)]


_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEPT = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=np.uint64)
LONG_WORD = 1024


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the splitmix64 finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, start, end) of every word of the texts, and each text's first word (n + 1 places).

    Words are maximal runs of bytes that are not blank; starts and ends are byte positions. A word
    is hashed eight bytes at a time, all words at once; a very long one by BLAKE2.
    """
    starts, ends = runs(~BLANK[content], offsets[:-1][offsets[:-1] < len(content)], 1)
    lengths = ends - starts
    padded = np.concatenate([content, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(content) + 1,), "<u8", padded, strides=(1,))
    hashes = lengths.astype(np.uint64) * _ODD
    rest, at = np.flatnonzero(lengths <= LONG_WORD), 0
    while len(rest):
        begin = starts[rest] + at
        piece = eights[begin] & _KEPT[np.minimum(lengths[rest] - at, 8)]
        hashes[rest] = mixed(hashes[rest] + piece) * _ODD
        at += 8
        rest = rest[lengths[rest] > at]
    for k in np.flatnonzero(lengths > LONG_WORD):
        digest = hashlib.blake2b(content[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        hashes[k] = int.from_bytes(digest, "little")
    return mixed(hashes), starts, ends, np.searchsorted(starts, offsets)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (texts are not told apart)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(n):  # by Horner's rule, so the order of the words counts
        total *= _ODD
        total += hashes[k : k + count]
    return mixed(total)
