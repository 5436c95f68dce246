import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import recompression, texts


def brute(docs, window):
    """(doc_id, words, removed, kept) by counting every window."""
    words = [(text or "").encode().split() for _, text in docs]
    times = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = {
            k
            for i in range(len(w) - window + 1)
            if times[tuple(w[i : i + window])] > 1
            for k in range(i, i + window)
        }
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((doc_id, len(w), len(gone), kept))
    return sorted(out, key=str)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(70)]
    found = []
    for i in range(120):
        words = [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(0, 160))]
        if i % 4 == 0:
            a = rng.randrange(0, 30)
            words[10:10] = passage[a : a + rng.choice([34, 35, 36, 40])]
        if i % 7 == 0:
            words += ["tick", "tock"] * 40
        if i % 9 == 0:
            words += ["same"] * rng.choice([34, 35, 36, 80])
        found.append((" " if i % 2 else "\n").join(words))
    found += found[5:8] + [found[3] + " tail", None, "", "\t"]
    return list(enumerate(found))


@pytest.mark.parametrize("window", [35, 8])
def test_corpus(spark, corpus, window):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)
    assert table(recompression.deduplicated(docs, window)) == brute(corpus, window)


def test_odd_docs(odd_docs, texts_of):
    assert table(recompression.deduplicated(odd_docs)) == brute(texts_of, 35)


def test_empty_table(no_docs):
    assert recompression.deduplicated(no_docs).collect() == []


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_symbols_recur_where_the_words_they_rest_on_do(letters):
    rng = random.Random(letters)
    for _ in range(60):
        found = [[rng.randrange(letters) for _ in range(rng.randrange(0, 60))] for _ in range(4)]
        names = texts.mixed(np.array([x for w in found for x in w], dtype=np.uint64))
        first = np.cumsum([0] + [len(w) for w in found])
        held = recompression.symbols(names, first)
        assert held.start.tolist() == sorted(set(held.start.tolist()))
        assert np.array_equal(np.append(held.start[1:], len(names)), held.end)
        by_place = dict(zip(held.start.tolist(), zip(held.name, held.end, strict=True), strict=True))
        where = defaultdict(list)
        told = held.telling(35)
        widths = {int(held.high[k] - held.low[k]) for k in told}
        for t in range(4):
            for width in widths:
                for p in range(first[t], first[t + 1] - width + 1):
                    where[names[p : p + width].tobytes()].append(p)
        for k in told:
            low, high = int(held.low[k]), int(held.high[k])
            assert 0 <= low <= held.start[k] and held.end[k] <= high <= len(names)
            for p in where[names[low:high].tobytes()]:
                name, end = by_place[p + int(held.start[k]) - low]
                assert name == held.name[k] and end - p == held.end[k] - low


def test_equal_names_stand_for_equal_words():
    rng = np.random.default_rng(1)
    names = texts.mixed(rng.integers(1, 6, 4000).astype(np.uint64))
    held = recompression.symbols(names, np.array([0, 4000]))
    meaning = {}
    for name, a, b in zip(held.name, held.start, held.end, strict=True):
        assert meaning.setdefault(int(name), names[a:b].tobytes()) == names[a:b].tobytes()
