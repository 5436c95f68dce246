"""Substring dedup by recompression: named runs and pairs rule out what occurs once."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import texts, workers
from tidemark.session import stored

WINDOW = 35
ROUNDS = 5
LEAST_WORDS = 4  # symbols of fewer words occur everywhere and are not counted
BUCKET_BYTES = 24 << 20  # text bytes for each bucket of names
LEAST_BUCKETS = 32
AT = np.dtype([("key", "<i8"), ("place", "<u4")])
OUTSIDE = 1 << 30

_PAIR, _RUN = np.uint64(0xD1342543DE82EF95), np.uint64(0x9E3779B97F4A7C15)


class Symbols:
    """Symbols of a part of the texts: name, first word, end, and the words their shape rests on.

    `low` and `high` bound the words that decide a symbol: wherever those words recur, so does the
    symbol. A symbol that also rests on a text's beginning or end reaches OUTSIDE.
    """

    def __init__(self, names: np.ndarray, first: np.ndarray):
        count = len(names)
        self.name = names
        self.start = np.arange(count, dtype=np.int32)
        self.end = self.start + np.int32(1)
        self.low, self.high = self.start.copy(), self.end.copy()
        self.opens = np.zeros(count + 1, dtype=bool)  # where a text begins; one more at the end
        self.opens[first] = True
        self.opens[count] = True

    def runs(self) -> None:
        """Names every maximal run of one symbol; a run rests on the symbols beside it."""
        starts = self.opens[:-1].copy()
        starts[1:] |= self.name[1:] != self.name[:-1]
        begin = np.flatnonzero(starts)
        last = np.append(begin[1:], len(self.name)) - 1
        times = (last - begin + 1).astype(np.uint64)
        low, high = self.low[begin], self.high[last]
        low[1:] = np.minimum(low[1:], self.low[begin[1:] - 1])
        high[:-1] = np.maximum(high[:-1], self.high[last[:-1] + 1])
        low[self.opens[begin]] = -OUTSIDE
        high[self.opens[last + 1]] = OUTSIDE
        name = self.name[begin]
        run = times > 1
        name[run] = texts.mixed(name[run] * _PAIR + texts.mixed(times[run] + _RUN))
        self.name, self.low, self.high = name, low, high
        self.start, self.end = self.start[begin], self.end[last]
        self.opens = np.append(self.opens[begin], True)

    def pairs(self, turn: int) -> None:
        """Names every pair of a left and a right symbol; a bit of the name tells the side.

        A pair rests on its two symbols only. A left symbol that stays alone rests on the next one
        too, a right one on the one before.
        """
        left = (texts.mixed(self.name ^ np.uint64(turn + 77)) & np.uint64(1)).astype(bool)
        inner = ~self.opens[1:-1]  # symbol and next one belong to one text
        joins = left[:-1] & ~left[1:] & inner
        head, tail = np.append(joins, False), np.concatenate([[False], joins])
        low, high = self.low, self.high
        new_low, new_high = low.copy(), high.copy()
        alone = left & ~head
        use = joins | (alone[:-1] & inner)
        new_low[:-1][use] = np.minimum(low[:-1], low[1:])[use]
        new_high[:-1][use] = np.maximum(high[:-1], high[1:])[use]
        new_high[alone & self.opens[1:]] = OUTSIDE
        alone = ~left & ~tail
        use = alone[1:] & inner
        new_low[1:][use] = np.minimum(low[1:], low[:-1])[use]
        new_high[1:][use] = np.maximum(high[1:], high[:-1])[use]
        new_low[alone & self.opens[:-1]] = -OUTSIDE
        name, end = self.name.copy(), self.end.copy()
        at = np.flatnonzero(joins)
        name[at] = texts.mixed(
            self.name[at] * _PAIR + texts.mixed(self.name[at + 1] + np.uint64(turn))
        )
        end[at] = self.end[at + 1]
        keep = ~tail
        self.name, self.start, self.end = name[keep], self.start[keep], end[keep]
        self.low, self.high = new_low[keep], new_high[keep]
        self.opens = np.append(self.opens[:-1][keep], True)

    def telling(self, window: int) -> np.ndarray:
        """Symbols long enough to be rare whose words and surroundings fit into a window."""
        wide = self.end - self.start >= LEAST_WORDS
        return np.flatnonzero(wide & (self.high.astype(np.int64) - self.low <= window))


def symbols(names: np.ndarray, first: np.ndarray) -> Symbols:
    """High-level symbols of the texts whose words are `names` (see texts.words for `first`)."""
    found = Symbols(names, first[:-1])
    if len(names):
        found.runs()
        for turn in range(ROUNDS):
            found.pairs(turn)
    return found


def _places(first: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """(key of the text, word number in it) of word numbers of the part."""
    text = np.searchsorted(first, at, side="right") - 1
    found = np.empty(len(at), AT)
    found["key"], found["place"] = keys[text], at - first[text]
    return found


def _parts(texts_column: pa.Array, keys: np.ndarray) -> Iterator[tuple]:
    """(rows, names of the words, first words, keys) by part, each different text once."""
    _, unique = np.unique(keys, return_index=True)
    unique = np.sort(unique)
    content, offsets = texts.flat(texts_column.take(pa.array(unique)))
    for a, b in texts.parts(offsets):
        base = offsets[a]
        names, _, _, first = texts.words(content[base : offsets[b]], offsets[a : b + 1] - base)
        yield unique[a:b], names, first, keys[unique[a:b]]


def _dealt(names: np.ndarray, at: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, names, at) rows: named places by bucket of the name.

    A name that is repeated here is sent once, so a frequent one costs a row a part, and its places,
    known to be shared already, are sent without names.
    """
    order = np.argsort(names, kind="stable")
    names, at = names[order], at[order]
    begin, end = texts.groups(names)
    known = at[np.repeat(end - begin > 1, end - begin)]
    names, at = names[begin], at[begin]
    rows: list[tuple] = []
    for kind, bucket in (
        (True, (names % np.uint64(buckets)).astype(np.int64)),
        (False, known["key"] % buckets),
    ):
        held = at if kind else known
        order = np.argsort(bucket, kind="stable")
        bucket, held = bucket[order], held[order]
        for a, b in zip(*texts.groups(bucket), strict=True):
            named = names[order[a:b]].tobytes() if kind else None
            rows.append((int(bucket[a]), named, held[a:b].tobytes()))
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "names", "at"]
    )


def shared_places(named: DataFrame, buckets: int) -> DataFrame:
    """(key, places): the places, as sorted 4-byte numbers, whose names occur at two places."""

    @workers.lean_group
    def find(frame: pd.DataFrame) -> pd.DataFrame:
        with_names = frame.names.notna()
        parts = [np.frombuffer(x, AT) for x in frame["at"][~with_names]]
        if with_names.any():
            names = np.concatenate([np.frombuffer(x, np.uint64) for x in frame.names[with_names]])
            at = np.concatenate([np.frombuffer(x, AT) for x in frame["at"][with_names]])
            order = np.lexsort((at["place"], at["key"], names))
            names, at = names[order], at[order]
            new = np.ones(len(names), dtype=bool)  # copies of a text send the same places
            new[1:] = (names[1:] != names[:-1]) | (at[1:] != at[:-1])
            names, at = names[new], at[new]
            twice = np.zeros(len(names) + 1, dtype=bool)
            twice[1:-1] = names[1:] == names[:-1]
            parts.append(at[twice[1:] | twice[:-1]])
        found = np.concatenate(parts) if parts else np.empty(0, AT)
        owner = found["key"] % buckets
        order = np.argsort(owner, kind="stable")
        owner, found = owner[order], found[order]
        begin, end = texts.groups(owner)
        blobs = [found[a:b].tobytes() for a, b in zip(begin, end, strict=True)]
        return pd.DataFrame({"owner": owner[begin], "at": blobs})

    @workers.lean_group
    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        found = np.unique(np.concatenate([np.frombuffer(x, AT) for x in frame["at"]]))
        keys, begin = np.unique(found["key"], return_index=True)
        places = np.split(found["place"], begin[1:])
        return pd.DataFrame({"key": keys, "places": [p.tobytes() for p in places]})

    found = named.groupBy("bucket").applyInPandas(find, "owner long, at binary")
    return found.groupBy("owner").applyInPandas(gather, "key long, places binary")


def _named_symbols(window: int, buckets: int) -> Callable:
    @workers.lean
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, names, first, keys in _parts(batch.column(1), batch.column(0).to_numpy()):
                found = symbols(names, first)
                told = found.telling(window)
                at = _places(first, found.start[told], keys)
                yield from _dealt(found.name[told], at, buckets)

    return name


def _named_windows(window: int, buckets: int) -> Callable:
    @workers.lean
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            for rows, names, first, keys in _parts(batch.column(1), batch.column(0).to_numpy()):
                found = symbols(names, first)
                shared = np.zeros(len(names), dtype=bool)
                for row, begin in zip(rows, first, strict=False):
                    if places[int(row)].is_valid:
                        held = np.frombuffer(places[int(row)].as_buffer(), np.uint32)
                        shared[begin + held] = True
                told = found.telling(window)
                told = told[~shared[found.start[told]]]
                # a window over all that such a symbol rests on occurs once
                change = np.zeros(len(names) + 2, dtype=np.int64)
                np.add.at(change, np.maximum(found.high[told] - window, 0), 1)
                np.add.at(change, found.low[told] + 1, -1)
                possible = np.cumsum(change)[: len(names)] == 0
                for end in first[1:]:  # windows lie within a text
                    possible[max(int(end) - window + 1, 0) : end] = False
                starts = np.flatnonzero(possible)
                grams = texts.ngrams(names, window)
                yield from _dealt(grams[starts], _places(first, starts, keys), buckets)

    return name


def covered(n_words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words the windows at `starts` cover."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    change[starts] += 1
    np.add.at(change, np.minimum(starts + window, n_words), -1)
    return np.cumsum(change[:n_words]) > 0


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept of each row of (doc_id, text).

    A word (between white space, unchanged) is removed if a window of `window` words covers it whose
    word sequence also starts anywhere else, in the same text or another one; `kept` joins the other
    words by one blank. Windows are judged on the input.

    1. Recompression: in each round, runs and then pairs of neighbouring symbols get names that are
       hashes of what they join, so all tasks give equal strings equal names without a dictionary.
       A symbol knows which words it rests on; wherever these recur, it does.
    2. The names of high-level symbols are counted over all texts. A window over everything that a
       symbol with a single occurrence rests on cannot occur twice.
    3. The windows that remain are compared by a 64-bit hash of their words over all texts.

    A text that occurs in several rows counts as one text in 2 and 3; all its windows occur twice, so
    every word goes if it has `window` words. A name or window is sent once for each part of the texts that
    repeats it, so passages in a third of all texts make no large group.

    Null and empty texts have no words. Repeated rows repeat their windows. Null doc_ids are allowed,
    as texts are told apart by hash. An empty table gives an empty result; other columns are not read.
    """
    workers.ready(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("key"), text.alias("text"))
    each = rows.groupBy("key").agg(
        F.count("*").alias("copies"), F.first(F.octet_length("text")).alias("bytes")
    )
    each = stored(each)
    total = each.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(total / BUCKET_BYTES))
    schema = "bucket long, names binary, at binary"
    named = rows.select("key", "text").mapInArrow(_named_symbols(window, buckets), schema)
    shared = stored(shared_places(named, buckets))
    marked = rows.select("key", "text").join(shared, "key", "left")
    buckets *= 4
    named = marked.mapInArrow(_named_windows(window, buckets), schema)
    repeated = shared_places(named, buckets)
    several = each.filter("copies > 1").select("key", F.lit(True).alias("several"))
    repeated = stored(repeated.join(several, "key", "full"))

    @workers.lean
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            columns = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for text, places, several in zip(*columns, strict=True):
                words = text.encode().split()  # at the same six bytes
                n_words.append(len(words))
                if several and len(words) >= window:
                    words = []
                elif places:
                    drop = covered(len(words), np.frombuffer(places, np.uint32).astype(int), window)
                    words = [w for w, gone in zip(words, drop, strict=True) if not gone]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    result = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    final = rows.join(repeated, "key", "left").select("doc_id", "text", "places", "several")
    return final.mapInArrow(remove, result)
