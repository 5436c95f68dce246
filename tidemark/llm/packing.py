"""Packing tokenised documents into windows: best-fit decreasing over a segment tree."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import workers

# Fixed value: the splitting pattern of byte-level BPE vocabularies.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
# Letters beyond these blocks may be classed by different Unicode versions; `tokenizers` decides.
SETTLED = re.compile("[^\u0000-߿‐-‧€]")
SLICE = 1 << 22
BLOCK_TOKENS = 1 << 22


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> uint32 ids of the vocabulary at `path`, special tokens not added.

    `tokenizers` defines the ids. A plain byte-level BPE whose merges stand in the order of their
    ids gives the same ids by rank order alone, which `tiktoken` computes several times faster;
    texts with special tokens or letters beyond `SETTLED` still go to `tokenizers`.
    """
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(path)

    def exact(text: str) -> np.ndarray:
        return np.array(reference.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    ids = [model["vocab"].get(a + b, -1) for a, b in merges]
    plain = (
        model["type"] == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex") is True
        and not before.get("add_prefix_space")
        and not any(spec[k] for k in ("normalizer", "post_processor", "truncation", "padding"))
        and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))
        and ids == sorted(set(ids))
    )
    if not plain:
        return exact
    import tiktoken

    letters = _byte_letters()
    special = [t["content"] for t in spec["added_tokens"]]
    ranks = {
        bytes(letters[c] for c in token): i
        for token, i in model["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SETTLED.search(text) or any(s in text for s in special):
            return exact(text)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Parts of a very long text, cut before a blank between two letters, where tokens end too."""
    cut, at = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])"), 0
    while len(text) - at > size and (found := cut.search(text, at + size)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class Capacities:
    """Segment tree over remaining capacities: which is the smallest one that still fits?"""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, remaining: int, window: int) -> None:
        self.open[remaining].append(window)
        node = remaining + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(remaining capacity, window) of the tightest open window that holds `length`."""
        count, node = self.count, length + self.leaves
        while not count[node]:  # climb to the first subtree on the right that holds a window
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        remaining = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return remaining, self.open[remaining].pop()


Piece = tuple[int, int, int]  # document, start, length


def best_fit(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """Windows filled by best-fit decreasing."""
    tree, windows = Capacities(window), []
    for piece in sorted(pieces, key=lambda p: -p[2]):
        found = tree.take(piece[2])
        if found is None:
            found = (window, len(windows))
            windows.append([])
        remaining, number = found
        windows[number].append(piece)
        if remaining > piece[2]:
            tree.add(remaining - piece[2], number)
    return windows


def top_up(windows: list[list[Piece]], window: int) -> list[list[Piece]]:
    """Padding removed: the emptiest windows are cut up to fill the gaps of the fullest.

    What is left at the end goes into windows whose lengths are powers of two.
    """
    load = [sum(p[2] for p in w) for w in windows]
    gaps = sorted((i for i in range(len(windows)) if load[i] < window), key=lambda i: load[i])
    full = [w for w, used in zip(windows, load, strict=True) if used == window]
    loose: list[Piece] = []
    while gaps:
        if not loose:
            loose = windows[gaps.pop(0)]
            continue
        target, room = windows[gaps[-1]], window - load[gaps[-1]]
        document, start, length = loose.pop()
        taken = min(room, length)
        target.append((document, start, taken))
        load[gaps[-1]] += taken
        if taken < length:
            loose.append((document, start + taken, length - taken))
        if taken == room:
            full.append(windows[gaps.pop()])
    rest = sum(p[2] for p in loose)
    while rest:
        size, part = 1 << (rest.bit_length() - 1), []
        rest -= size
        while size:
            document, start, length = loose.pop()
            taken = min(size, length)
            part.append((document, start, taken))
            if taken < length:
                loose.append((document, start + taken, length - taken))
            size -= taken
        full.append(part)
    return full


def _packer(path: str, end_id: int, window: int, block_tokens: int):
    @workers.lean
    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []  # doc_id, start, length, doc_tokens, sequence_id, offset, ids
        tails: list[tuple] = []  # doc_id, start of the tail, doc_tokens, ids of the tail
        waiting, size, schema = 0, 0, None

        def flush_tails() -> None:
            nonlocal sequence, waiting, size
            pieces = [(k, 0, len(t[3])) for k, t in enumerate(tails)]
            for content in top_up(best_fit(pieces, window), window):
                offset = 0
                for k, start, length in content:
                    doc_id, begin, total, ids = tails[k]
                    part = ids[start : start + length].tobytes()
                    rows.append((doc_id, begin + start, length, total, sequence, offset, part))
                    offset += length
                sequence += 1
            size += waiting
            waiting = 0
            tails.clear()

        def flush_rows() -> pa.RecordBatch:
            nonlocal size
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [schema.field(0).type, *[pa.int64()] * 5, pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            rows.clear()
            size = 0
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            schema = batch.schema
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tail, start, whole, first = np.empty(0, np.uint32), 0, [], len(rows)
                for part in [*slices(text or ""), None]:
                    ids = np.array([end_id], np.uint32) if part is None else encode(part)
                    tail = np.concatenate([tail, ids]) if len(tail) else ids
                    for at in range(0, len(tail) - window + 1, window):
                        whole.append((start, tail[at : at + window].tobytes()))
                        start += window
                    tail = tail[len(tail) - len(tail) % window :]
                total = start + len(tail)
                for begin, ids in whole:  # an overlong document fills windows of its own
                    rows.append((doc_id, begin, window, total, sequence, 0, ids))
                    sequence += 1
                size += window * (len(rows) - first)
                if len(tail):
                    tails.append((doc_id, start, total, tail.copy()))
                    waiting += len(tail)
                if waiting >= block_tokens:
                    flush_tails()
                if size >= block_tokens:
                    yield flush_rows()
        if schema is not None:
            flush_tails()
            yield flush_rows()

    return pack_partition


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    window: int = 2048,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Pieces of (doc_id, text): doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    Every document is tokenised and closed by `end_id`. Full windows are cut off first; the tails
    are placed by best-fit decreasing, in blocks of about `block_tokens` tokens within a task, so
    memory is bounded and nothing is shuffled. The few windows left open at the end of a block are
    topped up by cutting, so only powers of two below `window` remain. `ids` holds little-endian
    unsigned 32-bit ids; `sequence_id` is unique and carries the task number in its upper half.

    A null or empty text is its `end_id` alone. Rows with the same doc_id, also a null one, are
    packed separately. Ties in length keep the order of the input. An empty table gives no pieces.
    Columns other than doc_id and text are not read. A window must be a power of two.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    workers.ready(docs.sparkSession)
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [
            T.StructField(name, T.LongType())
            for name in ("start", "length", "doc_tokens", "sequence_id", "offset")
        ]
        + [T.StructField("ids", T.BinaryType())]
    )
    return docs.select("doc_id", "text").mapInArrow(
        _packer(tokenizer_path, end_id, window, block_tokens), schema
    )
