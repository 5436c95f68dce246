"""Prefix trie of conversations: padded turn-id matrices of range shards, sorted and summed by column."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import workers
from tidemark.operators import joins
from tidemark.session import stored

HEAD = 8  # turns that a conversation can take from another, crc32 % 9 at most
FAMILY = 5
BLOCK = 64  # turns in a row of a matrix; longer conversations have several rows
SHARD_ROWS = 16_384
STRETCH = 4_096  # rows of one window; longer series are summed stretch by stretch
LAST = np.iinfo(np.int64).max

PIECE = 512  # ids in a piece of the list of those that end at a node

KEY = ["depth", "key1", "key2"]
NODE = (
    "kind string, depth long, key1 long, key2 long, parent1 long, parent2 long, parent_conv_id long,"
    " conv_id long, n_convs long, n_bytes long, n_children long, n_leaves long, saved long,"
    " ends string, shard int, piece int"
)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, n_bytes) of every row with a conv_id; id is the MD5 of role and text.

    Texts stay where they are read; all that follows works on ids.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id is not null").select(
        "conv_id",
        "turn",
        F.unhex(F.md5(name)).alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` with `place`, from 1, within its conversation by turn (null first), then id.

    Rows are sorted by ranges, so a conversation of any size lies in several tasks; what a task has
    to know of the ones before is how many rows of its first conversation they hold.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    index = F.monotonically_increasing_id()
    ranged = ranged.withColumns({"task": F.shiftright(index, 33), "line": index.bitwiseAND((1 << 33) - 1)})
    ranged = stored(ranged)
    held = ranged.groupBy("task", "conv_id").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    held = stored(held)
    whole = held.groupBy("conv_id").agg(F.count("*").alias("tasks")).filter("tasks > 1")
    # one row for each border between two tasks at most, so the window is over few rows
    crossing = held.join(whole.select("conv_id"), "conv_id", "left_semi")
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    carried = crossing.withColumn("carried", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    starts = held.join(carried.select("task", "conv_id", "carried"), ["task", "conv_id"], "left")
    offset = F.coalesce("carried", F.lit(0)) - F.col("first")
    starts = starts.select("task", "conv_id", offset.alias("offset"))
    # both sides lie by task and conversation; a long one is a group of rows for each task it spans
    found = ranged.join(starts, ["task", "conv_id"])
    return found.select(*rows.columns, (F.col("line") + F.col("offset") + 1).alias("place"))


def taken(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family: crc32 of its id, mod 9."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, id, n_bytes) of the rebuilt conversations, and their (conv_id, length).

    Conversation c starts with the first h turns of c - c % 5, where h = crc32(c) % 9, and goes on with
    its own from h + 1 on. Own turns are met with their shift by conversation and stretch, so the
    turns of a very long conversation are spread.
    """
    rows = stored(numbered(turns(conversations)))
    first = F.col("place") <= HEAD
    turn = F.when(first, F.struct("place", "id", "n_bytes"))
    per = rows.groupBy("conv_id").agg(
        F.count("*").alias("own"), F.sort_array(F.collect_list(turn)).alias("head")
    )
    per = stored(per)
    base = per.select(F.col("conv_id").alias("base"), F.col("head").alias("given"))
    h = taken(F.col("conv_id"))
    per = per.withColumns({"base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": h})
    per = per.select("conv_id", "own", "base", "h").join(base, "base", "left")
    given = F.coalesce(F.slice("given", F.lit(1), F.col("h").cast("int")), F.slice("given", 1, 0))
    per = per.withColumn("given", given)
    size = F.when(F.col("given").isNull(), 0).otherwise(F.size("given")).cast("long")
    per = per.withColumn("size", size)
    per = stored(per.withColumn("length", F.col("size") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    heads = per.select("conv_id", F.inline("given")).withColumnRenamed("place", "depth")
    stretch = F.floor(F.col("place") / STRETCH)
    shifts = per.filter("own > h").select(
        "conv_id",
        "h",
        (F.col("size") - F.col("h")).alias("shift"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("own") / STRETCH))).alias("stretch"),
    )
    own = rows.withColumn("stretch", stretch).join(shifts, ["conv_id", "stretch"]).filter("place > h")
    own = own.select("conv_id", (F.col("place") + F.col("shift")).alias("depth"), "id", "n_bytes")
    return heads.unionByName(own), per.select("conv_id", "length")


def before(rows: DataFrame, key: str, at: str, names: list[str], add, join) -> DataFrame:
    """`rows` with `add` over the `names` of the rows of the key at smaller `at`, as before_<name>.

    A window runs over a stretch of `at` and one over the stretches, so a key of any size is
    spread; (key, at) is unique. `join` adds two results, either of which may be null.
    """
    rows = rows.withColumn("stretch", F.floor(F.col(at) / STRETCH))
    per = rows.groupBy(key, "stretch").agg(*[add(n).alias(f"all_{n}") for n in names])
    earlier = Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = per.select(key, "stretch", *[add(f"all_{n}").over(earlier).alias(f"all_{n}") for n in names])
    within = Window.partitionBy(key, "stretch").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"before_{n}": add(n).over(within) for n in names})
    rows = rows.join(totals, [key, "stretch"])
    rows = rows.withColumns({f"before_{n}": join(f"before_{n}", f"all_{n}") for n in names})
    return rows.drop("stretch", *[f"all_{n}" for n in names])


def _or_zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0).cast("long"))


def segments(conversations: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """Rows of the matrices: (conv_id, block, prefix1, prefix2, cells, more) of every conversation.

    Cells are (id1, id2, n_bytes) of at most `block_size` turns, the ids of a turn being two hashes of its
    depth and its MD5. A prefix is known by the XOR of the ids of its turns, so that of a block
    needs no walk through the ones before. A conversation without turns has one row without cells.
    """
    rows, lengths = rebuilt(conversations)
    ids = [F.xxhash64(F.lit(seed), "depth", "id").alias(f"id{seed}") for seed in (1, 2)]
    block = F.floor((F.col("depth") - 1) / block_size)
    rows = rows.select("conv_id", "depth", block.alias("block"), *ids, "n_bytes")
    cell = F.struct("depth", "id1", "id2", "n_bytes")
    rows = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(cell)).alias("cells"),
        F.bit_xor("id1").alias("id1"),
        F.bit_xor("id2").alias("id2"),
    )
    rows = stored(rows.withColumn("cells", F.transform("cells", lambda c: c.dropFields("depth"))))
    parts = lengths.select(
        "conv_id",
        "length",
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / block_size))
        ).alias("block"),
    )
    long = rows.join(lengths.filter(F.col("length") > block_size).select("conv_id"), "conv_id", "left_semi")
    prefixes = before(
        long.drop("cells"),
        "conv_id",
        "block",
        ["id1", "id2"],
        F.bit_xor,
        lambda a, b: _or_zero(a).bitwiseXOR(_or_zero(b)),
    ).select("conv_id", "block", *[F.col(f"before_id{k}").alias(f"prefix{k}") for k in (1, 2)])
    rows = parts.join(rows.drop("id1", "id2"), ["conv_id", "block"], "left")
    rows = rows.join(prefixes, ["conv_id", "block"], "left")
    more = F.col("length") > (F.col("block") + 1) * block_size
    prefix = [_or_zero(f"prefix{k}").alias(f"prefix{k}") for k in (1, 2)]
    return rows.select("conv_id", "block", *prefix, "cells", more.alias("more"))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(block, prefixes, ids 1, ids 2, bytes, lengths, conversations, more) of a shard, sorted by
    block, prefix, ids column by column, whether it goes on, and conversation; short rows are padded at
    the end."""
    cells = batch.column("cells")
    lengths = np.nan_to_num(cells.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    width = int(lengths.max(initial=0))
    filled = np.arange(width) < lengths[:, None]
    inner, padded = cells.flatten(), []
    for name in ("id1", "id2", "n_bytes"):
        out = np.zeros((len(lengths), width), np.int64)
        out[filled] = inner.field(name).to_numpy(zero_copy_only=False)
        padded.append(out)
    column = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names if n != "cells"}
    keys = [column["conv_id"], column["more"]]
    for k in reversed(range(width)):
        keys += [padded[1][:, k], padded[0][:, k], filled[:, k]]
    keys += [column["prefix2"], column["prefix1"], column["block"]]
    order = np.lexsort(keys)
    prefixes = np.stack([column["prefix1"], column["prefix2"]], axis=1)
    found = [column["block"], prefixes, *padded, lengths, column["conv_id"], column["more"].astype(bool)]
    return tuple(f[order] for f in found)


def _nodes(batch: pa.RecordBatch, shard: int, block_size: int) -> Iterator[pa.RecordBatch]:
    """Nodes of a shard, column by column of its matrix, as rows of NODE.

    kind `closed`: a node whose whole subtree lies in the shard, with its final figures; conv_id of
    its parent, or the parent's key where that is open. `open`: what the shard knows of a node that
    others may know of too: those of its first or last row, those that reach into the next block, and
    column 0, the root or what a block goes on from. Its n_children, n_leaves and saved are of the
    closed nodes that have no other open node above them. `ends`: conversations that end at an open
    node. `path`: an open node of a conversation that may be the least of some open node.
    """
    block, prefix, id1, id2, n_bytes, length, conv, more = _matrix(batch)
    n, columns = len(conv), id1.shape[1] + 1
    depth = block[:, None] * block_size + np.arange(columns)
    lanes = [
        np.bitwise_xor.accumulate(np.concatenate([prefix[:, [k]], ids], axis=1), axis=1)
        for k, ids in enumerate((id1, id2))
    ]
    size = np.concatenate([np.zeros((n, 1), np.int64), n_bytes], axis=1)
    valid = np.arange(columns) <= length[:, None]
    change = np.ones((n, columns), bool)
    change[1:, 0] = (block[1:] != block[:-1]) | (prefix[1:] != prefix[:-1]).any(axis=1)
    change[1:, 1:] = (id1[1:] != id1[:-1]) | (id2[1:] != id2[:-1]) | (valid[1:, 1:] != valid[:-1, 1:])
    start = np.logical_or.accumulate(change, axis=1) & valid
    reaching = more.copy()
    reaching[[0, -1]] = True

    firsts = [np.flatnonzero(start[:, k]) for k in range(columns)]
    segment = np.cumsum(start, axis=0) - 1
    counts, least, opened = [], [], []
    open_cell, candidate = np.zeros((n, columns), bool), more.copy()
    own = np.zeros((n, columns), np.int64)
    for k, rows in enumerate(firsts):
        held = valid[:, k]
        counts.append(np.add.reduceat(held.astype(np.int64), rows))
        least.append(np.minimum.reduceat(np.where(held, conv, LAST), rows))
        opened.append(np.logical_or.reduceat(held & reaching, rows) | (k == 0))
        open_cell[:, k] = held & opened[k][segment[:, k]]
        candidate |= open_cell[:, k] & (conv == least[k][segment[:, k]])
        own[rows, k] = (counts[k] - 1) * size[rows, k]

    closed_start = start & ~open_cell
    leaf = np.zeros((n, columns), bool)
    children = []
    for k, rows in enumerate(firsts):
        below = closed_start[:, k + 1] if k + 1 < columns else np.zeros(n, bool)
        children.append(np.add.reduceat(below.astype(np.int64), rows))
        leaf[rows, k] = (children[k] == 0) & closed_start[rows, k]
    # what rows hold from a column on: a subtree is the rows of its node and the columns from it on
    saved_on = np.cumsum((own * closed_start)[:, ::-1], axis=1)[:, ::-1]
    leaves_on = np.cumsum(leaf[:, ::-1], axis=1, dtype=np.int64)[:, ::-1]
    deepest = open_cell.sum(axis=1) - 1  # open nodes are a row's first ones
    named = conv.astype(str).tolist()

    def records(kind: str, rows: np.ndarray, k: int, **given) -> pa.RecordBatch:
        given |= {"depth": depth[rows, k], "key1": lanes[0][rows, k], "key2": lanes[1][rows, k]}
        cells = []
        for name, of in (part.split() for part in NODE.split(", ")):
            cast = pa.int64() if of == "long" else pa.int32() if of == "int" else pa.string()
            if name == "kind":
                cells.append(pa.array([kind] * len(rows), cast))
            elif name == "shard":
                cells.append(pa.array(np.full(len(rows), shard, np.int32)))
            elif name in given:
                values = given[name]
                cells.append(values if isinstance(values, pa.Array) else pa.array(values, cast))
            else:
                cells.append(pa.nulls(len(rows), cast))
        return pa.RecordBatch.from_arrays(cells, names=[part.split()[0] for part in NODE.split(", ")])

    for k, rows in enumerate(firsts):
        ended = valid[:, k] & (length == k) & ~more
        n_ended = np.add.reduceat(ended.astype(np.int64), rows)  # they come first in a node
        above = max(k - 1, 0)
        closed = np.flatnonzero(~opened[k])
        at = rows[closed]
        if len(at):
            under_open = open_cell[at, above]
            yield records(
                "closed",
                at,
                k,
                parent1=pa.array(lanes[0][at, above], mask=~under_open),
                parent2=pa.array(lanes[1][at, above], mask=~under_open),
                parent_conv_id=pa.array(least[above][segment[at, above]], mask=under_open),
                n_convs=counts[k][closed],
                conv_id=least[k][closed],
                n_children=children[k][closed],
                n_leaves=np.add.reduceat(leaves_on[:, k], rows)[closed],
                saved=np.add.reduceat(saved_on[:, k], rows)[closed],
                ends=[
                    hashlib.sha256(",".join(named[a : a + e]).encode()).hexdigest()
                    for a, e in zip(at.tolist(), n_ended[closed].tolist(), strict=True)
                ],
            )
        chosen = np.flatnonzero(opened[k])
        at = rows[chosen]
        if not len(at):
            continue
        here = valid[:, k] & (deepest == k)
        new = (k > 0) | (block[at] == 0)  # column 0 of a later block is counted in the one before
        top = np.full(len(at), k == 0)
        yield records(
            "open",
            at,
            k,
            parent1=pa.array(lanes[0][at, above], mask=top),
            parent2=pa.array(lanes[1][at, above], mask=top),
            n_convs=np.where(new, counts[k][chosen], 0),
            conv_id=pa.array(least[k][chosen], mask=~new),
            n_bytes=size[at, k],
            n_children=np.add.reduceat(np.where(here, _next(closed_start, k), 0), rows)[chosen],
            n_leaves=np.add.reduceat(np.where(here, leaves_on[:, k], 0), rows)[chosen],
            saved=np.add.reduceat(np.where(here, saved_on[:, k], 0), rows)[chosen],
        )
        pieces = [
            (row, p, ",".join(named[a : min(a + PIECE, row + e)]))
            for row, e in zip(at.tolist(), n_ended[chosen].tolist(), strict=True)
            for p, a in enumerate(range(row, row + e, PIECE))
        ]
        if pieces:
            at, number, joined = zip(*pieces, strict=True)
            yield records("ends", np.array(at), k, piece=number, ends=joined)
        at = np.flatnonzero(candidate & open_cell[:, k] & ((k > 0) | (block == 0)))
        if len(at):
            yield records("path", at, k, conv_id=conv[at])


def _next(cells: np.ndarray, k: int) -> np.ndarray:
    return cells[:, k + 1].astype(np.int64) if k + 1 < cells.shape[1] else np.zeros(len(cells), np.int64)


def shard_nodes(
    rows: DataFrame, block_size: int = BLOCK, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """NODE rows of all shards: ranges of `segments` by block, prefix, ids and conversation.

    The conversation is part of the range key, so copies of one text, however many, lie in several
    shards of about `shard_rows` rows, which each task sorts and sums as one matrix.
    """
    workers.ready(rows.sparkSession)
    shards = max(1, math.ceil(rows.count() / shard_rows))
    ids = F.transform("cells", lambda c: F.struct(c["id1"], c["id2"]))
    ranged = rows.repartitionByRange(shards, "block", "prefix1", "prefix2", ids, "more", "conv_id")

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield from _nodes(whole, TaskContext.get().partitionId(), block_size)

    return ranged.mapInArrow(workers.lean(in_task), NODE)


def digests(ends: DataFrame) -> DataFrame:
    """(depth, key1, key2, ends_sha256): the digest of each node's ids, joined in ascending order.

    SHA-256 reads its input in order, so the pieces of a node pass through one task; it holds a
    batch of them at a time, never a node's whole list.
    """

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            found = []
            for *key, piece in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != node:
                    if node is not None:
                        found.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            yield _digest_rows(found)
        if node is not None:
            yield _digest_rows([(*node, state.hexdigest())])

    pieces = ends.repartition(*KEY).sortWithinPartitions(*KEY, "shard", "piece").select(*KEY, "ends")
    return pieces.mapInArrow(in_task, "depth long, key1 long, key2 long, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[*KEY, "ends_sha256"])


def _recombined(found: DataFrame) -> DataFrame:
    """The open nodes of all shards with their final figures, and parent1, parent2."""
    part = found.filter("kind = 'open'").groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("parent1", "parent2", "n_bytes")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.min("conv_id").alias("conv_id"),
    )
    part = stored(part)
    under = part.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent1").alias("key1"), F.col("parent2").alias("key2")
    )
    part = part.join(under.agg(F.count("*").alias("under")), KEY, "left")
    part = part.withColumn("n_children", F.col("n_children") + _or_zero("under")).drop("under")
    own = (F.col("n_convs") - 1) * F.col("n_bytes") + F.col("saved")
    leaves = F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    part = stored(part.withColumns({"own": own, "leaves": leaves}))
    # An open node counts for its least conversation. That one is the least of all its deeper nodes
    # too, so the sum over a subtree is the sum over its members of all that counts for them, less
    # what counts for the node's own least conversation further up.
    per = part.groupBy("conv_id").agg(F.sum("own").alias("own"), F.sum("leaves").alias("leaves"))
    paths = found.filter("kind = 'path'").select("conv_id", *KEY)
    sums = joins.lookup(paths, per, "conv_id", "inner", stored=False).groupBy(*KEY)
    sums = sums.agg(F.sum("own").alias("all_own"), F.sum("leaves").alias("all_leaves"))
    part = before(
        part, "conv_id", "depth", ["own", "leaves"], F.sum, lambda a, b: _or_zero(a) + _or_zero(b)
    )
    part = part.join(sums, KEY).join(digests(found.filter("kind = 'ends'")), KEY, "left")
    return part.select(
        *KEY,
        "parent1",
        "parent2",
        "conv_id",
        "n_convs",
        "n_children",
        (F.col("all_leaves") - F.col("before_leaves")).alias("n_leaves"),
        (F.col("all_own") - F.col("before_own")).alias("saved"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends"),
    )


def trie(
    conversations: DataFrame, block_size: int = BLOCK, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations (see rebuilt): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; turns of a conversation are ordered by number, null first, and
    those of equal number by the MD5 of role and text, so repeated rows are turns of their own. Rows
    with a null conv_id take no part. A text of any size counts through its digest and its bytes; a
    conversation of any length is cut into blocks. An empty table has no root and gives no rows;
    other columns are not read.
    """
    rows = stored(segments(conversations, block_size))
    found = stored(shard_nodes(rows, block_size, shard_rows))
    whole = stored(_recombined(found))
    named = whole.select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    figures = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    columns = [*figures, "parent_conv_id"]

    def by_parent(nodes: DataFrame) -> DataFrame:
        key = [(F.col("depth") - 1).alias("depth"), F.col("parent1").alias("key1")]
        rest = [c for c in nodes.columns if c not in (*KEY, "parent_conv_id")]
        return nodes.select(*key, F.col("parent2").alias("key2"), F.col("depth").alias("own"), *rest)

    def placed(nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("depth", F.col("own")).select(*columns)

    # A parent's conv_id comes to its open children, and to the closed ones shard by shard: a parent
    # with very many children is met once a shard, and its children there are at most the shard's.
    here = stored(found.filter("kind = 'open'").select("shard", *KEY).distinct().join(named, KEY))
    closed = found.filter("kind = 'closed'")
    inner = closed.filter("parent_conv_id is not null").select(*columns)
    fringe = by_parent(closed.filter("parent_conv_id is null")).join(here, ["shard", *KEY])
    root = whole.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    below = joins.lookup(by_parent(whole.filter("depth > 0")), named, KEY, "inner", stored=False)
    fringe, below, root = placed(fringe), placed(below), root.select(*columns)
    rows = inner.unionByName(fringe).unionByName(root).unionByName(below)
    return rows.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
