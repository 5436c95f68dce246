"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersections."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts, workers
from tidemark.llm.components import components
from tidemark.session import discard, stored

WORDS, PERCENT = 5, 75
BUCKET_KEYS = 1 << 19  # shingles sorted by one task at a time
TILE_ROWS, TILE_BYTES = 1024, 32 << 20  # of one size band; a tile holds two such parts at most
GROUP_BYTES = 16 << 20
LONG_LIST, SEED_LISTS = 64, 8  # of the lists so long, one in so many is compared first
FREQUENT_IN_PART, FREQUENT, FREQUENT_MOST, COMMON_WORDS = 4, 32, 1 << 18, 1 << 10

# A to Z in lower case, other bytes as they are.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


class Order(NamedTuple):
    """What is put last among the members of a set: frequent shingles, and those of common words.

    Any order gives the same links; this one keeps apart sets that share common phrases only.
    """

    shingles: np.ndarray
    words: np.ndarray


class Sets:
    """Sorted distinct shingle hashes of a part of the texts."""

    def __init__(self, content: np.ndarray, offsets: np.ndarray, n: int):
        self.n = n
        self.words, _, _, self.first = texts.words(_LOWER[content], offsets)
        self.grams = texts.ngrams(self.words, n)
        self.sets = [self._distinct(self.grams, a, b) for a, b in self._texts()]

    def _texts(self) -> Iterator[tuple[int, int]]:
        return zip(self.first[:-1], self.first[1:], strict=True)

    def _distinct(self, grams: np.ndarray, a: int, b: int) -> np.ndarray:
        if b - a >= self.n:
            own = np.sort(grams[a : b - self.n + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            return own[keep]
        if b > a:  # fewer words than a shingle: the whole sequence, told apart by length
            return texts.mixed(texts.ngrams(self.words[a:b], int(b - a)) ^ np.uint64(b - a))
        return self.words[:0]

    def prefixes(self, order: Order, percent: int) -> list[np.ndarray]:
        """The first size - ceil(size * percent / 100) + 1 members of each set, as sortable keys.

        A key puts frequent shingles last, and others the later the more common words they hold;
        its lower bits are the hash. As it depends on the shingle alone, two sets at or above the
        threshold, which share that many members, share one within their prefixes.
        """
        common = np.concatenate([[0], np.cumsum(_among(self.words, order.words))])
        held = np.minimum(common[self.n :] - common[: -self.n], 7)[: len(self.grams)]
        last = _among(self.grams, order.shingles).astype(np.uint64) << np.uint64(63)
        keys = last | (held.astype(np.uint64) << np.uint64(60)) | (self.grams >> np.uint64(4))
        found = []
        for own, (a, b) in zip(self.sets, self._texts(), strict=True):
            length = len(own) - (len(own) * percent + 99) // 100 + 1
            found.append(self._distinct(keys, a, b)[: length if len(own) else 0])
        return found


def set_hash(own: np.ndarray) -> int:
    """64-bit name of a set (signed, as Spark's longs are)."""
    total = np.add.reduce(texts.mixed(own ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
    return int(texts.mixed(np.array([total + np.uint64(len(own))])).view(np.int64)[0])


def bitmap(own: np.ndarray) -> np.ndarray:
    """Hashed bits of a set, at least two for every member, in 64-bit words."""
    size = 1 << max(6, (2 * len(own) - 1).bit_length())
    place = own & np.uint64(size - 1)
    words = np.zeros(size // 64, dtype=np.uint64)
    np.bitwise_or.at(words, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    return words


def band(size: Column, percent: int) -> Column:
    """Sizes whose ratio allows a link lie in the same or in neighbouring bands."""
    return F.floor(F.log(size.cast("double")) / F.lit(_band_width(percent))).cast("int")


def _band_width(percent: int) -> float:
    # those of 99 hold equal sizes together, too, and are few enough to count by
    return math.log(100 / min(percent, 99)) + 1e-9


def _bands(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.floor(np.log(sizes) / _band_width(percent)).astype(np.int64)


def _band_type(percent: int) -> np.dtype:
    """A type that tells the bands of all sizes apart: a byte as long as 2^63 shingles have fewer."""
    largest = _bands(np.array([2.0**63]), percent)[0]
    return np.dtype(np.uint8 if largest < 256 else np.uint16)


def _by_part(column: pa.Array, n: int) -> Iterator[Sets]:
    content, offsets = texts.flat(column)
    for first, last in texts.parts(offsets):
        base = offsets[first]
        part = content[base : offsets[last]]
        yield Sets(part, offsets[first : last + 1] - base, n)


def described(docs: DataFrame, n: int) -> DataFrame:
    """One row a document (doc_id, sig, size, bits); besides, (kind, hash, seen) of frequent shingles
    and words.

    A part of the texts reports the shingles that several of its different sets hold, and the words
    that are a thousandth of its words.
    """

    @workers.lean
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, sizes, bits = [], [], []
            kinds, hashes, counts = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for part in _by_part(batch.column(1), n):
                different = {}
                for own in part.sets:
                    sizes.append(len(own))
                    sigs.append(set_hash(own) if len(own) else None)
                    bits.append(bitmap(own).tobytes() if len(own) else None)
                    different[sigs[-1]] = own
                for kind, values, least in (
                    ("shingle", np.concatenate(list(different.values())), FREQUENT_IN_PART),
                    ("word", part.words, max(len(part.words) // 1000, FREQUENT_IN_PART)),
                ):
                    seen, times = np.unique(values, return_counts=True)
                    many = times >= least
                    kinds += [kind] * int(many.sum())
                    hashes.append(seen[many].view(np.int64))
                    counts.append(times[many])
            none, blank = len(kinds), len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(none, batch.column(0).type)]),
                    pa.array(sigs + [None] * none, pa.int64()),
                    pa.array(sizes + [None] * none, pa.int64()),
                    pa.array(bits + [None] * none, pa.binary()),
                    pa.array([None] * blank + kinds, pa.string()),
                    pa.concat_arrays([pa.nulls(blank, pa.int64()), pa.array(np.concatenate(hashes))]),
                    pa.concat_arrays([pa.nulls(blank, pa.int64()), pa.array(np.concatenate(counts))]),
                ],
                names=["doc_id", "sig", "size", "bits", "kind", "hash", "seen"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        describe,
        f"doc_id {kind}, sig long, size long, bits binary, kind string, hash long, seen long",
    )


def frequency_order(described_rows: DataFrame) -> Order:
    """At most FREQUENT_MOST of the most frequent shingles and COMMON_WORDS of the commonest words."""

    def most(kind: str, count: int) -> np.ndarray:
        found = described_rows.filter(F.col("kind") == kind).groupBy("hash")
        found = found.agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= FREQUENT)
        rows = found.orderBy(F.col("seen").desc(), "hash").limit(count).collect()
        return np.sort(np.array([r["hash"] for r in rows], dtype=np.int64).view(np.uint64))

    return Order(most("shingle", FREQUENT_MOST), most("word", COMMON_WORDS))


def prefix_blobs(docs: DataFrame, order: Order, buckets: int, n: int, percent: int) -> DataFrame:
    """(bucket, blob): the prefix keys of every set, its name and its size band, by bucket."""

    kind = _band_type(percent)

    @workers.lean
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_part(batch.column(0), n):
                heads = part.prefixes(order, percent)
                different = {
                    set_hash(own): (head, len(own))
                    for own, head in zip(part.sets, heads, strict=True)
                    if len(own)
                }
                if not different:
                    continue
                heads, sizes = zip(*different.values(), strict=True)
                lengths = [len(h) for h in heads]
                keys = np.concatenate(heads)
                names = np.repeat(np.array(list(different), dtype=np.int64), lengths)
                bands = np.repeat(_bands(np.array(sizes), percent), lengths)
                bucket = (texts.mixed(keys) % np.uint64(buckets)).astype(np.int64)
                by_bucket = np.argsort(bucket, kind="stable")
                bucket, keys, names, bands = (x[by_bucket] for x in (bucket, keys, names, bands))
                start, end = texts.groups(bucket)
                blobs = [
                    keys[a:b].tobytes() + names[a:b].tobytes() + bands[a:b].astype(kind).tobytes()
                    for a, b in zip(start, end, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[start]), pa.array(blobs, pa.binary())],
                    names=["bucket", "blob"],
                )

    return docs.select("text").mapInArrow(spread, "bucket long, blob binary")


def _unpacked(blobs: pd.Series, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = [len(b) // (16 + kind.itemsize) for b in blobs]
    keys = [np.frombuffer(b, np.uint64, c) for b, c in zip(blobs, counts, strict=True)]
    names = [np.frombuffer(b, np.int64, c, 8 * c) for b, c in zip(blobs, counts, strict=True)]
    bands = [np.frombuffer(b, kind, c, 16 * c) for b, c in zip(blobs, counts, strict=True)]
    return np.concatenate(keys), np.concatenate(names), np.concatenate(bands)


def _shared_lists(frame: pd.DataFrame, kind: np.dtype) -> pd.DataFrame:
    """Sorted names of the sets that share a prefix shingle, each different list once.

    Within a list, a set stays only beside another one of its size band or a neighbouring band.
    """
    keys, names, bands = _unpacked(frame.blob, kind)
    order = np.lexsort((names, keys))
    keys, names, bands = keys[order], names[order], bands[order].astype(np.int64)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    keys, names, bands = keys[new], names[new], bands[new]
    begin, end = texts.groups(keys)
    several = end - begin > 1
    lists = set()
    for a, b in zip(begin[several], end[several], strict=True):
        held, own = names[a:b], bands[a:b]
        here = np.bincount(own, minlength=own.max() + 2)
        near = here[own] + here[own + 1] + np.where(own > 0, here[own - 1], 0)
        held = held[near > 1]
        if len(held) > 1:
            lists.add(held.tobytes())
    return pd.DataFrame({"members": list(lists)})


class Tile:
    """Sets of a tile in the order of their sizes, with bounds on their overlaps."""

    def __init__(self, sizes: np.ndarray, maps: list[np.ndarray], percent: int):
        self.sizes, self.maps, self.percent = sizes, maps, percent
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        widths = np.array([len(m) for m in maps])
        for width in np.unique(widths):
            rows = np.flatnonzero((widths == width) | (widths == 2 * width))
            held = [
                maps[k] if widths[k] == width else maps[k][:width] | maps[k][width:] for k in rows
            ]
            self.levels[int(width)] = rows, np.stack(held)

    def possible(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` (larger or equal, ascending) whose overlap may reach the threshold.

        A bit set in one map only stands for a member that the other set lacks, so the bits that
        differ bound the overlap from above.
        """
        rows, maps = self.levels[len(self.maps[i])]
        at = np.searchsorted(rows, others)
        own, theirs = self.maps[i], maps[at]
        most = np.minimum(
            self.sizes[i] - np.bitwise_count(own & ~theirs).sum(axis=1),
            self.sizes[others] - np.bitwise_count(theirs & ~own).sum(axis=1),
        ).astype(np.int64)
        total = self.sizes[i] + self.sizes[others]
        return others[(100 + self.percent) * most >= self.percent * total]

    def forest(
        self,
        exact: Callable[[int, int], bool] | None,
        cross: np.ndarray | None,
        label: np.ndarray,
    ):
        """Pairs that join the sets linked in this tile; sets already joined are not compared.

        `label` tells which sets are joined from the start; `cross` marks the two parts of a tile
        whose inner pairs other tiles compare.
        """
        label = label.copy()
        # 100 * smaller >= percent * larger
        window = np.searchsorted(self.sizes, self.sizes * 100 // self.percent, side="right")
        links = []
        for i in range(len(self.sizes)):
            others = np.arange(i + 1, window[i])
            others = others[label[others] != label[i]]
            if cross is not None:
                others = others[cross[others] != cross[i]]
            if not len(others):
                continue
            for j in self.possible(i, others):
                if label[j] != label[i] and (exact is None or exact(i, j)):
                    links.append((i, j))
                    label[label == label[j]] = label[i]
        return links


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def tiled(members: DataFrame, percent: int, weight: Column) -> DataFrame:
    """(tile, part, all columns) of members (list, sig, size, ...) that take `weight` bytes each.

    Lists are cut by size band, and a band of a list by hash into parts of about TILE_ROWS rows or
    TILE_BYTES bytes, whichever is less; a set that is longer is a part of its own. A tile holds two
    parts whose bands allow links, or one part by itself; a list that is small as a whole is one tile.
    """
    members = members.withColumn("band", band(F.col("size"), percent))
    counts = members.groupBy("list", "band")
    counts = stored(counts.agg(F.count("*").alias("rows"), F.sum(weight).alias("bytes")))
    totals = counts.groupBy("list").agg(F.sum("rows").alias("all"), F.sum("bytes").alias("held"))
    large = (F.col("all") > 2 * TILE_ROWS) | (F.col("held") > 2 * TILE_BYTES)
    long = counts.join(totals.filter(large).select("list"), "list")
    cuts = F.greatest(F.ceil(F.col("rows") / TILE_ROWS), F.ceil(F.col("bytes") / TILE_BYTES))
    long = long.withColumn("cuts", F.least(cuts, F.col("rows")).cast("int"))
    long = stored(long.drop("rows", "bytes"))
    short = members.join(long.select("list").distinct(), "list", "left_anti")
    one = short.withColumns({"part": F.lit(-1).cast("long"), "tile": F.lit("")})
    parts = members.join(long, ["list", "band"])
    parts = parts.withColumn("part", F.pmod(F.xxhash64("sig"), F.col("cuts").cast("long")).cast("int"))
    near = long.select(
        "list",
        F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
        F.col("band").alias("band2"),
        F.col("cuts").alias("cuts2"),
    )
    pairs = parts.join(near, ["list", "band"]).drop("cuts")
    pairs = pairs.withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("cuts2") - 1)))
    here = F.format_string("%d.%d", "band", "part")
    there = F.format_string("%d.%d", "band2", "part2")
    pairs = pairs.withColumn("tile", F.concat_ws("-", F.least(here, there), F.greatest(here, there)))
    pairs = pairs.withColumn("part", F.xxhash64("band", "part"))
    columns = [*members.columns, "part", "tile"]
    return one.select(*columns).unionByName(pairs.select(*columns))


def _forests(
    members: DataFrame, groups: int, percent: int, payload: str, exact: bool
) -> DataFrame:
    """(a, b): pairs of names that join the linked sets of every tile."""

    @workers.lean_group
    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["list", "tile", "size", "sig"]).drop_duplicates(
            ["list", "tile", "sig"]
        )
        kept = [np.frombuffer(x, np.uint64) for x in frame[payload]]
        sizes, names = frame["size"].to_numpy(), frame.sig.to_numpy()
        parts, joined = frame.part.to_numpy(), frame.joined.to_numpy()
        change = (frame.list != frame.list.shift()) | (frame.tile != frame.tile.shift())
        start = np.flatnonzero(change.to_numpy())
        found = []
        for a, b in zip(start, np.append(start[1:], len(frame)), strict=True):
            own = kept[a:b]
            maps = [bitmap(x) for x in own] if exact else own

            def enough(i: int, j: int, own=own) -> bool:
                total = len(own[i]) + len(own[j])
                return (100 + percent) * _overlap(own[i], own[j]) >= percent * total

            two = len(set(parts[a:b])) > 1
            tile = Tile(sizes[a:b], maps, percent)
            links = tile.forest(
                enough if exact else None, parts[a:b] if two else None, joined[a:b]
            )
            found += [(names[a + i], names[a + j]) for i, j in links]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    task = F.pmod(F.xxhash64("list", "tile"), F.lit(groups))
    return members.withColumn("task", task).groupBy("task").applyInPandas(link, "a long, b long")


def _set_arrays(docs: DataFrame, n: int) -> DataFrame:
    @workers.lean
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_part(batch.column(0), n):
                held = [own for own in part.sets if len(own)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_hash(own) for own in held], pa.int64()),
                        pa.array([own.tobytes() for own in held], pa.binary()),
                    ],
                    names=["sig", "members"],
                )

    return docs.select("text").mapInArrow(arrays, "sig long, members binary")


def near_duplicates(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of (doc_id, text).

    A document's set holds the distinct n-word shingles of its whole text (A-Z in lower case, words
    between white space; with fewer words, all of them as one shingle). Two documents link when
    100 * intersection >= percent * union; component_id is the smallest doc_id reachable by links.

    1. One scan gives each set's name (a 64-bit hash; equal sets are one from here on), size and
       bitmap, and the shingles and words that are frequent somewhere.
    2. A second scan deals the prefix of each set, common phrases last, to buckets as arrays.
       Sets that share a prefix shingle and lie in near size bands form a list; each different list
       is kept once.
    3. Tiles of a list compare bitmaps: the bits that differ bound the overlap from above. Only a
       forest of the possible links is kept, and its components are clusters of candidates. Some
       of the long lists go first; lists whose sets are joined by then need no comparison.
    4. The texts of these clusters are read again, and tiles of each cluster intersect the sorted
       shingle arrays exactly, unless two sets are already joined. The forests' components are the
       result.

    The texts meet the ids by hash, whatever the number of ids: texts are not sorted, and no plan
    depends on a broadcast that the next size no longer allows. No pairs are listed: tiles return
    forests. Lists and clusters of any size are cut into tiles, of rows and of bytes.

    Null and empty texts have no shingles and link with nothing. Repeated rows and equal texts have
    equal sets and so one component. Null doc_ids do not count as smallest; a component without
    another id has a null one. An empty table gives an empty result; other columns are not read.
    """
    workers.ready(docs.sparkSession)
    rows = stored(described(docs, n))
    order = frequency_order(rows)
    each = rows.filter("size is not null").select("doc_id", "sig", "size", "bits")
    known = stored(
        each.filter("sig is not null")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("bits").alias("bits"))
    )
    total = known.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total * (100 - percent) / 100 / BUCKET_KEYS))
    blobs = prefix_blobs(docs, order, buckets, n, percent)
    kind = _band_type(percent)
    shared = workers.lean_group(lambda frame: _shared_lists(frame, kind))
    lists = stored(blobs.groupBy("bucket").applyInPandas(shared, "members binary").distinct())
    unnested = stored(_unnested(lists))
    discard(lists)
    possible, parts = _candidate_forest(unnested, known, percent)
    discard(unnested)
    found = components(possible)
    discard(*parts)
    clusters = found.select(
        F.col("node").alias("sig"), F.col("component").alias("list")
    )
    clusters = stored(clusters.join(known.select("sig", "doc_id", "size"), "sig"))
    wanted = clusters.select("doc_id").distinct()
    texts_of = docs.select("doc_id", "text").join(
        wanted.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi"
    )
    arrays = _set_arrays(texts_of, n)
    members = clusters.select("list", "sig", "size", F.col("sig").alias("joined"))
    weight = 8 * F.col("size") + 64
    tiles = stored(tiled(members, percent, weight))
    held = tiles.agg(F.sum(weight)).first()[0] or 0
    members = tiles.join(arrays, "sig")
    links = _forests(members, 1 + held // GROUP_BYTES, percent, "members", exact=True)
    linked = stored(components(links))
    named = known.join(linked, known["sig"] == linked["node"], "left")
    named = named.select("sig", "doc_id", F.coalesce("component", "sig").alias("class"))
    least = stored(named.groupBy("class").agg(F.min("doc_id").alias("component_id")))
    named = stored(named.join(least, "class").select("sig", "component_id"))
    found = each.select("doc_id", "sig", "size").join(named, "sig", "left")
    own = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))


def _unnested(lists: DataFrame) -> DataFrame:
    """(list, sig, rows) of lists of names: one row a member, with the length of its list."""

    @workers.lean
    def unnest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            if held:
                rows = [len(x) for x in held]
                names = np.repeat(batch.column(0).to_numpy(), rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names),
                        pa.array(np.concatenate(held)),
                        pa.array(np.repeat(np.array(rows, dtype=np.int64), rows)),
                    ],
                    names=["list", "sig", "rows"],
                )

    named = lists.select(F.xxhash64("members").alias("list"), "members")
    return named.mapInArrow(unnest, "list long, sig long, rows long")


def _candidate_forest(
    lists: DataFrame, known: DataFrame, percent: int
) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b): pairs that join all sets whose bitmaps allow a link within a list; and the written
    tables they are read from.

    Near copies share many lists that differ a little. So one in SEED_LISTS of the long lists is
    compared first, and lists whose members that has joined already are left out of the rest.
    """
    described_sets = known.select("sig", "size", "bits")

    def compared(members: DataFrame) -> DataFrame:
        rows = stored(members.join(described_sets, "sig"))
        weight = F.octet_length("bits").cast("long") + 64
        tiles = stored(tiled(rows, percent, weight))
        discard(rows)
        held = tiles.agg(F.sum(weight)).first()[0] or 0
        links = stored(_forests(tiles, 1 + held // GROUP_BYTES, percent, "bits", exact=False))
        discard(tiles)
        return links

    seeds = lists.filter((F.col("rows") >= LONG_LIST) & (F.col("list") % SEED_LISTS == 0))
    alone = lists.select("list", "sig", F.col("sig").alias("joined"))
    if seeds.isEmpty():
        links = compared(alone)
        return links, [links]
    first = compared(seeds.select("list", "sig", F.col("sig").alias("joined")))
    joined = stored(components(first))
    labelled = lists.join(joined, lists["sig"] == joined["node"], "left")
    labelled = stored(
        labelled.select("list", "sig", F.coalesce("component", "sig").alias("joined"))
    )
    apart = labelled.groupBy("list").agg(F.min("joined").alias("low"), F.max("joined").alias("high"))
    apart = stored(apart.filter("low <> high").select("list"))
    rest = compared(labelled.join(apart, "list", "left_semi"))
    discard(labelled, apart)
    return first.unionByName(rest), [first, rest]


def one_per_group(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose doc_id is their component's (see near_duplicates).

    Rows that repeat a doc_id count as one document: the one with the smallest text stays. Rows
    without a doc_id stay.
    """
    groups = near_duplicates(docs, n, percent)
    stay = groups.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows"))
    stay = stored(stay)
    single = docs.join(stay.filter("rows = 1").hint("shuffle_hash"), "doc_id", "left_semi")
    kept = single.unionByName(docs.filter("doc_id is null"))
    if stay.filter("rows > 1").isEmpty():
        return kept
    several = docs.join(stay.filter("rows > 1"), "doc_id", "left_semi")
    first = several.groupBy("doc_id").agg(F.min_by(F.struct("*"), F.struct("text")).alias("row"))
    return kept.unionByName(first.select("row.*"))
