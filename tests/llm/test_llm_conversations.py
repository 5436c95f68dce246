import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations

DDL = "conv_id long, turn long, role string, text string, key1 string, depth int, kind string"


def rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is None:
            continue
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
        turns[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for _, _, _, r, t in sorted(found)] for c, found in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    return out


def brute_force(rows):
    whole = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        if not children[node]:
            leaves[node] = 1
        if node:
            saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode())
            children[node[:-1]] += 1
            saved[node[:-1]] += saved[node]
            leaves[node[:-1]] += leaves[node]
    found = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in held if len(whole[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append(
            (held[0], len(node), parent, len(held), children[node], leaves[node], saved[node], digest)
        )
    return sorted(found, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def given(spark):
    """Copies, common beginnings, long and odd conversations."""
    random = np.random.default_rng(3)
    rows = []
    for c in range(-20, 160):
        if c % 13 == 0:
            continue
        length = int(random.integers(1, 12))
        for turn in range(length):
            role = ["user", "assistant", None][turn % 3]
            rows.append((c, turn, role, ["", "ä", "bé", None, "text"][int(random.integers(0, 5))]))
    for c in range(1000, 1400):  # one very common conversation
        rows += [(c, 1, "user", "héllo"), (c, 2, "assistant", "the same"), (c, 3, "user", "bye")] * 4
    for c in (2000, 2001, 2002, 2003):  # long ones with a common beginning
        rows += [(c, k, "user", f"turn {k if k < 150 + c - 2000 else (k, c)}") for k in range(220)]
    rows += [(3, None, "user", "no number"), (3, None, None, None), (3, 1, "user", "ü"), (3, 1, "user", "ü")]
    rows += [(None, 1, "user", "no conversation"), (5000, None, None, None), (7777, 5, "x" * 9, "y" * 200_000)]
    rows = [(*r, "k", 7, "open") for r in rows]
    return spark.createDataFrame(rows, DDL).repartition(6), rows


@pytest.mark.parametrize("block, shard", [(64, 16_384), (64, 50), (3, 40), (1, 7)])
def test_trie_equals_brute_force(monkeypatch, given, block, shard):
    monkeypatch.setattr(conversations, "STRETCH", 16)
    df, rows = given
    found = rows_of(conversations.trie(df, block, shard))
    want = brute_force(rows)
    assert len(found) == len(want) and found == want


def test_one_turnless_and_no_conversations(spark):
    rows = [(c, 1, "user", "x", "k", 1, "k") for c in range(1, 60) if c % 5]
    df = spark.createDataFrame(rows, DDL)
    found = rows_of(conversations.trie(df))
    assert found == brute_force(rows)
    assert any(not t for t in rebuilt(rows).values())
    assert conversations.trie(df.limit(0)).collect() == []
    assert conversations.trie(df.withColumn("conv_id", F.lit(None).cast("long"))).collect() == []


def test_places_within_conversations_of_any_size(spark):
    rows = [(c, k, "u", "t", "", 0, "") for c, n in ((1, 500), (2, 1), (3, 40)) for k in range(n)]
    df = conversations.turns(spark.createDataFrame(rows, DDL).repartition(5))
    found = defaultdict(list)
    for r in conversations.numbered(df).collect():
        found[r.conv_id].append((r.turn, r.place))
    assert {c: [p for _, p in sorted(v)] for c, v in found.items()} == {
        1: list(range(1, 501)), 2: [1], 3: list(range(1, 41))
    }


def test_no_conversation_is_collected_whole(given):
    longest = conversations.segments(given[0], 64).agg(F.max(F.size("cells"))).first()[0]
    assert longest == 64
