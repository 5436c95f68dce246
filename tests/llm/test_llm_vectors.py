import numpy as np
import pandas as pd
import pytest

from tidemark.llm import ann, maxscore

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rows = [
        (0, [1.0, 0.5, -0.25]),
        (50, [0.1, 0.2, 0.3]),
        (100, [0.1, 0.2, 0.3]),
        (1, [0.5, 0.5, 0.5]),
        (2, [0.5, 0.5, 0.5]),
        (2, [0.5, 0.5, 0.5]),
        (3, None),
        (4, [None, 1.0, 1.0]),
        (5, [NAN, 1.0, 1.0]),
        (6, [INF, 1.0, 1.0]),
        (7, []),
        (8, [0.0, 0.0, 0.0]),
        (9, [2.0]),
        (10, [-1.0, -1.0, -1.0, 4.0]),
        (None, [1.0, 1.0, 1.0]),
        (150, [0.0, 0.0, 0.0]),
        (200, None),
    ]
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, shard string, block int"
    )


def brute(rows, every, k, score, zeros):
    """(query, rank, id, score) over all rows, by definition."""
    held = {}
    for i, v in rows:
        bad = i is None or not v or any(x is None or not np.isfinite(x) for x in v)
        if not bad and (zeros or any(v)):
            held.setdefault(i, v)
    out = []
    for q in sorted(i for i in held if i % every == 0):
        found = sorted((-score(held[q], held[i]), i) for i in held if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return out


def whole_product(a, b):
    return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b, strict=False))


def table(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_top_k_of_odd_vectors(odd_vectors):
    rows = floats([(r.vec_id, r.embedding) for r in odd_vectors.collect()])
    given = maxscore.quantised(odd_vectors)
    found = maxscore.top_k(given.filter("vec_id % 50 = 0"), given, k=5, shard_rows=3, query_rows=2)
    assert table(found) == brute(rows, 50, 5, whole_product, zeros=True)


def few_postings(n=5000, dims=8):
    """Rows of which few have the strong component; the others are weak everywhere."""
    rng = np.random.default_rng(5)
    weights = rng.integers(-3, 4, (n, dims)).astype(float)
    weights[:, 0] = np.where(rng.random(n) < 0.02, rng.integers(500, 900, n), 0)
    return np.arange(n), weights, np.array([90.0, 2, -1, 3, 0, -2, 1, 1])


def test_only_essential_postings_are_scored_and_few_rows_probed_further():
    """Beyond the leaders that give the first threshold."""
    ids, weights, query = few_postings()
    expected = np.lexsort((ids, -(weights @ query)))[:5]
    postings = maxscore.Postings(ids, weights)
    scored, partial = [], postings._partial
    postings._partial = lambda rows, q, terms: scored.append((rows, len(terms))) or partial(rows, q, terms)
    found, scores = postings.top(-1, query, 5)
    assert found.tolist() == expected.tolist()
    assert scores.tolist() == (weights @ query)[expected].tolist()
    assert all((weights[rows, 0] > 0).all() for rows, _ in scored)
    assert sum(len(rows) * n for rows, n in scored) < 0.01 * weights.size


def test_a_threshold_of_another_shard_rules_out_all_but_ties():
    ids, weights, query = few_postings()
    scores = np.sort(weights @ query)[::-1]
    postings = maxscore.Postings(ids, weights)
    assert len(postings.top(-1, query, 5, scores[0] + 1)[0]) == 0
    assert postings.top(-1, query, 5, scores[2])[1].tolist() == scores[scores >= scores[2]][:5].tolist()


@pytest.mark.parametrize("dims", [1, 3, 16])
def test_top_of_ties_negatives_and_zeros_equals_a_full_sort(dims):
    rng = np.random.default_rng(dims)
    ids = rng.permutation(4500)
    weights = rng.integers(-2, 3, (4500, dims)).astype(float)
    postings = maxscore.Postings(ids, weights)
    for query in [*rng.integers(-2, 3, (6, dims)), np.zeros(dims), -np.ones(dims)]:
        score = weights @ query
        best = [j for j in np.lexsort((ids, -score)) if ids[j] != 7][:9]
        found = postings.top(7, query.astype(float), 9)
        assert found[0].tolist() == ids[best].tolist() and found[1].tolist() == score[best].tolist()


def test_negative_scores_only(spark):
    rows = [(i, [1.0 if i % 50 == 0 else -float(i)]) for i in range(0, 60)]
    given = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = maxscore.top_k(given.filter("vec_id % 50 = 0"), given, k=5, shard_rows=9)
    assert table(found) == brute(rows, 50, 5, whole_product, zeros=True)


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_top_k_of_random_vectors(spark, scale):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in scale * np.round(rng.normal(size=12), 1)]) for i in range(400)]
    given = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = maxscore.top_k(given.filter("vec_id % 50 = 0"), given, k=5, shard_rows=90)
    assert table(found) == brute(rows, 50, 5, whole_product, zeros=True)


def test_scores_beyond_64_bits_are_the_last_ones(spark):
    rows = [(0, [1e12, 0.0]), (1, [1e12, 0.0]), (2, [-1e12, 0.0])]
    given = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = table(maxscore.top_k(given.filter("vec_id = 0"), given, k=2))
    assert found == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_empty_tables(odd_vectors):
    none = odd_vectors.limit(0)
    given = maxscore.quantised(none)
    assert maxscore.top_k(given, given).collect() == []
    vectors = none.withColumnRenamed("embedding", "vector")
    assert ann.nearest(vectors, vectors).collect() == []


def test_nearest_of_odd_vectors_with_all_buckets(odd_vectors):
    rows = floats([(r.vec_id, r.embedding) for r in odd_vectors.collect()])
    given = odd_vectors.withColumnRenamed("embedding", "vector")
    found = table(
        ann.nearest(
            given.filter("vec_id % 50 = 0"), given, k=4, functions=2, width=50.0, probes=9, shard_rows=5
        )
    )
    wanted = brute(rows, 50, 4, lambda a, b: sum(x * y for x, y in zip(a, b, strict=False)), zeros=False)
    assert [f[:3] for f in found] == [w[:3] for w in wanted]
    assert np.allclose([f[3] for f in found], [w[3] for w in wanted])


def test_recall_on_the_driver_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = rows.withColumnRenamed("embedding", "vector")
    held = {r.vec_id: np.array(r.vector, float) for r in rows.collect()}
    found: dict = {}
    for r in ann.nearest(rows.filter("vec_id % 20 = 0"), rows, k=20).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, all_rows = np.array(list(held)), np.stack(list(held.values()))
    hits = 0
    for q, got in found.items():
        score = all_rows @ held[q]
        score[ids == q] = -np.inf
        hits += len({i for _, i, _ in got} & set(ids[np.argsort(-score)[:20]]))
        assert [g[0] for g in sorted(got)] == list(range(1, 21))
        assert np.allclose([s for _, i, s in got], [held[q] @ held[i] for _, i, _ in got], atol=1e-12)
    assert len(found) == sum(i % 20 == 0 for i in held) and hits >= 0.9 * 20 * len(found)


def clustered(rng, clusters=100, size=50):
    centres = rng.normal(size=(clusters, 64))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    rows = np.repeat(centres, size, axis=0) + rng.normal(size=(clusters * size, 64)) * 0.03
    return rows / np.linalg.norm(rows, axis=1)[:, None]


@pytest.mark.parametrize("longer", [1.0, 10.0])
def test_few_rows_are_scored_where_vectors_are_clustered(longer):
    held = clustered(np.random.default_rng(8))
    held[5] *= longer
    rows = pd.DataFrame({"vec_id": np.arange(len(held)), "vector": list(held)})
    asked = rows[rows.vec_id % 20 == 0]
    tally: list = []
    search = ann._nearest_in_shard(20, 800, ann.Hashes(64, 4, 8, 2.0, 11), 0.01, tally)
    found = search(asked, rows).groupby("query_id").vec_id.apply(set)
    score = held[asked.vec_id] @ held.T
    score[np.arange(len(asked)), asked.vec_id] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    assert sum(len(found[q] & set(b)) for q, b in zip(asked.vec_id, best, strict=True)) >= 0.9 * best.size
    assert sum(tally) < 0.2 * len(asked) * len(held)


def test_no_row_is_scored_twice_for_a_query():
    held = np.random.default_rng(9).normal(size=(2000, 16))
    held /= np.linalg.norm(held, axis=1)[:, None]
    rows = pd.DataFrame({"vec_id": np.arange(len(held)), "vector": list(held)})
    tally: list = []
    ann._nearest_in_shard(20, 6561, ann.Hashes(16, 4, 8, 2.0, 11), 0.0, tally)(rows[:50], rows)
    assert 0 < sum(tally) <= 50 * len(held)


def test_chances_are_those_of_random_projections():
    rng = np.random.default_rng(10)
    hashes = ann.Hashes(16, 400, 3, 1.0, 3)
    query = rng.normal(size=(1, 17))
    near = query + 0.4 * (step := rng.normal(size=(1, 17))) / np.linalg.norm(step)
    hits = chances = 0.0
    for table in range(400):
        keys, steps, inside = hashes.probes(query, table, 5)
        hits += hashes.place(near, table)[0][0] in keys[0]
        chances += hashes.chance(inside, steps, np.array([0.4]))[0]
    assert abs(hits - chances) < 0.08 * 400


def test_equal_vectors_rank_by_id(spark):
    rows = [(i, [0.1 * (i % 3 + 1), 0.7, -0.3]) for i in range(300)]
    given = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    found = table(ann.nearest(given.filter("vec_id = 20"), given, k=5, shard_rows=40))
    assert [f[2] for f in found] == [2, 5, 8, 11, 14]


@pytest.mark.parametrize(("count", "longer"), [(3000, 10.0), (15, 1.0), (21, 1.0)])
def test_nearest_beside_a_long_vector_and_among_few(spark, count, longer):
    rng = np.random.default_rng(4)
    held = rng.normal(size=(count, 64))
    held /= np.linalg.norm(held, axis=1)[:, None]
    held[7] *= longer
    rows = spark.createDataFrame(list(enumerate(held.tolist())), "vec_id long, vector array<double>")
    every = 20 if count > 100 else 1
    found: dict = {}
    for r in ann.nearest(rows.filter(f"vec_id % {every} = 0"), rows, k=20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    asked, wanted, hits = range(0, count, every), min(20, count - 1), 0
    for q in asked:
        score = held @ held[q]
        score[q] = -np.inf
        assert len(found[q]) == wanted
        hits += len(found[q] & set(np.argsort(-score)[:wanted].tolist()))
    assert hits >= (0.95 if count > 100 else 1) * wanted * len(asked)
