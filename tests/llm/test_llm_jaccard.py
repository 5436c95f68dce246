import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import components, jaccard_join, texts


def shingles(text):
    words = (text or "").encode().lower().split()  # bytes: only A-Z change
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, percent=75):
    """doc_id -> (size, component) by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for k, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if label[j] == label[k]]
        out.append((doc_id, len(sets[k]), min((i for i in ids if i is not None), default=None)))
    return sorted(out, key=str)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def family(rng, base, changes, count):
    """Variants of a text, each with some words replaced."""
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    found = []
    for size, changes, count in ((12, 1, 40), (60, 5, 60), (300, 14, 30), (5, 1, 12), (3, 1, 12)):
        base = [f"b{size}.{i}" for i in range(size)]
        found += family(rng, base, changes, count)
    for i in range(60):  # a passage that many texts share does not link them
        found.append(" ".join(passage + [f"u{i}.{k}" for k in range(30)]))
    found += ["Same Text here as below, word for word"] * 5 + ["SAME text HERE as BELOW, word for word"]
    found += [None, "", " \n\t"]
    rng.shuffle(found)
    return list(enumerate(found))


def test_links_of_a_corpus_with_many_borderline_pairs(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", 8)  # so lists and clusters are cut into tiles
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 6)  # and some lists are compared first
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    assert table(jaccard_join.near_duplicates(docs)) == brute(corpus)


def test_tiles_of_few_bytes(spark, corpus, monkeypatch):
    """Very long texts cut a cluster by bytes, with few rows a tile; links are the same."""
    monkeypatch.setattr(jaccard_join, "TILE_BYTES", 2000)
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 6)
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    assert table(jaccard_join.near_duplicates(docs)) == brute(corpus)


def test_tiles_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_BYTES", 10_000)
    sets = [(1, k, 100 + k % 3) for k in range(200)] + [(1, 900, 9000), (1, 901, 9001), (2, 7, 90), (2, 8, 90)]
    members = spark.createDataFrame(sets, "list long, sig long, size long")
    tiles = jaccard_join.tiled(members, 75, 8 * members["size"]).toPandas()
    by_tile = tiles.groupby(["list", "tile"])
    held = by_tile["size"].sum() * 8
    assert held[by_tile["sig"].nunique() > 2].max() < 2.5 * 20_000
    assert set(tiles[tiles.list == 2].tile) == {""}
    meet = {(a, b) for _, rows in by_tile for a in rows.sig for b in rows.sig}
    assert {(a, b) for a in range(200) for b in range(200)} | {(900, 901), (7, 8)} <= meet


@pytest.mark.parametrize("percent", [84, 85, 98, 99, 100])
def test_links_at_any_share(spark, percent):
    """At high shares there are many size bands; sizes about the 256th and the 512th of 99 link."""
    words = [f"w{i}" for i in range(700)]
    sizes = [*range(168, 182), 16, 17, 300, 301, 302, 600, 606, 612, 175, 600]
    docs = [(k, " ".join(words[:n])) for k, n in enumerate(sizes)]
    found = jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=percent)
    assert table(found) == brute(docs, percent)


def test_odd_docs(odd_docs, texts_of):
    assert table(jaccard_join.near_duplicates(odd_docs)) == brute(texts_of)


def test_empty_tables(no_docs):
    assert jaccard_join.near_duplicates(no_docs).collect() == []


def test_one_row_of_each_group_stays(spark):
    rows = [(2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (5, None)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, size string")
    assert table(jaccard_join.one_per_group(docs)) == [
        (1, "a b c d e f", "z"),
        (5, None, "z"),
        (None, "a b c d e f", "z"),
    ]


@pytest.mark.parametrize("hints", [0, 30])
def test_prefixes_of_linked_sets_meet(hints):
    rng, linked = random.Random(hints), 0
    words = [f"w{i}" for i in range(40)]
    for _ in range(150):
        base = [rng.choice(words) for _ in range(rng.randint(1, 90))]
        other = [w if rng.random() < 0.97 else "new" for w in base] + ["more"] * rng.randint(0, 3)
        content, offsets = texts.flat(pa.array([" ".join(base), "", " ".join(other)]))
        held = jaccard_join.Sets(content, offsets, 5)
        a, _, b = held.sets
        order = jaccard_join.Order(
            np.sort(np.array(rng.sample(list(held.grams), min(hints, len(held.grams))), np.uint64)),
            np.sort(np.array(rng.sample(list(held.words), min(hints, len(held.words))), np.uint64)),
        )
        heads = held.prefixes(order, 75)
        assert len(heads[1]) == 0
        if 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)):
            linked += 1
            assert len(np.intersect1d(heads[0], heads[2]))
    assert linked > 30


def test_bitmaps_bound_overlaps_from_above():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(4, 80))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = a[rng.random(len(a)) < rng.choice([0.3, 0.8, 0.95])]
        b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, n // 8 + 1).astype(np.uint64)]))
        a, b = sorted((a, b), key=len)
        if 100 * len(a) < 75 * len(b):
            continue
        tile = jaccard_join.Tile(np.array([len(a), len(b)]), [jaccard_join.bitmap(x) for x in (a, b)], 75)
        if 175 * jaccard_join._overlap(a, b) >= 75 * (len(a) + len(b)):
            assert tile.possible(0, np.array([1])).tolist() == [1]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    mixed = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges = chain + star + mixed + [(5, 5), (None, 3)]
    label = {n: n for e in edges for n in e if None not in e}
    for a, b in edges * 200:
        if a is not None and b is not None:
            label[a] = label[b] = min(label[a], label[b])
    linked = {n for a, b in edges if None not in (a, b) and a != b for n in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    found = {r.node: r.component for r in components.components(df).collect()}
    assert found == {n: label[n] for n in linked}
    assert components.components(df.limit(0)).collect() == []
