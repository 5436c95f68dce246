import hashlib
import math

import pytest

from tidemark.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Water filling by rounds: what exceeds a cap is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped: dict = {}
    while True:
        left = [s for s in order if s not in capped]
        pool = share * sum(sizes.values()) - sum(capped.values())
        total = sum(weight[s] for s in left)
        given = {s: pool * weight[s] / total for s in left}
        above = {s: most * sizes[s] for s in left if given[s] > most * sizes[s]}
        if not above:
            return capped | given
        capped |= above


def unit(doc_id, draw):
    digest = hashlib.md5(f"7:{draw}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(digest[:12], 16) / 2**48


def brute_copies(rows, sizes, targets):
    """Copies of (doc_id, source, size) rows, by the best of 32 draws for each source."""
    rate = {s: targets[s] / sizes[s] if sizes[s] else 0.0 for s in sizes}

    def copies(doc_id, source, draw):
        return math.floor(rate[source]) + (unit(doc_id, draw) < rate[source] % 1)

    def miss(source, draw):
        taken = sum(n * copies(i, s, draw) for i, s, n in rows if s == source)
        return round(abs(taken - targets[source]), 6), draw

    best = {s: min(miss(s, k) for k in range(32))[1] for s in sizes}
    return [copies(i, s, best[s]) for i, s, _ in rows]


def test_plan_and_copies(odd_docs):
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    size = [len((t or "").encode().split()) for _, t, _ in rows]
    sizes: dict = {}
    for (_, _, source), n in zip(rows, size, strict=True):
        sizes[source] = sizes.get(source, 0) + n
    targets = brute_targets(sizes)
    keyed = [(i, s, n) for (i, _, s), n in zip(rows, size, strict=True)]
    wanted = []
    for (doc_id, text, source), n, copies in zip(
        rows, size, brute_copies(keyed, sizes, targets), strict=True
    ):
        wanted.append((doc_id, text, source, n, sizes[source], round(targets[source], 6), copies))
    plan = mixing.copy_plan(odd_docs).collect()
    found = [
        (r.doc.doc_id, r.doc.text, r.doc.source, r["size"], r.source_size, round(r.target, 6), r.copies)
        for r in plan
    ]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(w[-1] for w in wanted)


def test_reruns_agree_and_targets_are_met(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), f"s{0 if i % 3 else i % 5}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plan = mixing.copy_plan(docs).selectExpr("doc.*", "size", "target", "copies")
    first = sorted(map(tuple, plan.collect()))
    again = sorted(map(tuple, mixing.copy_plan(docs.repartition(3)).selectExpr("doc.*", "size", "target", "copies").collect()))
    assert first == again
    taken: dict = {}
    for _, _, source, size, target, copies in first:
        assert copies <= 2
        taken.setdefault(source, [0, target])[0] += size * copies
    assert all(abs(words - target) < 0.005 * target + 7 for words, target in taken.values())


@pytest.mark.parametrize("texts", [[], [None, ""]])
def test_nothing_to_share(spark, texts):
    docs = spark.createDataFrame([(1, t, "a") for t in texts], "doc_id long, text string, source string")
    assert [r.copies for r in mixing.copy_plan(docs).collect()] == [0] * len(texts)
    assert mixing.mix(docs).collect() == []
