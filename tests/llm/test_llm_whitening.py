import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, whitening

DDL = "vec_id long, vector array<float>, n long, component string"


def reference(vectors):
    width = max(map(len, vectors))
    x = np.array(
        [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] + [100_000] * (width - len(v)) for v in vectors],
        float,
    )
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    sums = [int(s) for s in x.sum(axis=0)]
    deviation = [sum((len(x) * int(a) - s) ** 2 for a, s in zip(line, sums, strict=True)) for line in x]
    return centred, values[::-1], axes[:, ::-1], deviation


def check(df, vectors, k, tolerance=1e-7):
    rows = df.toPandas()
    centred, values, axes, deviation = reference(vectors)
    assert len(rows) == k * len(vectors) and set(rows.n) == {len(vectors)}
    assert rows.identity_error.nunique() == 1 and rows.identity_error.iloc[0] < 1e-6
    for c in range(1, k + 1):
        part = rows[rows.component == c].sort_values("vec_id")
        want = centred @ axes[:, c - 1] / np.sqrt(values[c - 1])
        sign = np.sign(want @ part.whitened.to_numpy())
        assert np.allclose(sign * want, part.whitened, atol=tolerance)
        assert np.allclose(part.explained, values[c - 1] / values.sum(), rtol=1e-8)
        assert [int(v) for v in part.deviation] == deviation


@pytest.mark.parametrize("spread", [1.0, 1e-3])
def test_whitening_equals_an_eigendecomposition(spark, spread):
    random = np.random.default_rng(1)
    scale = np.geomspace(1, spread, 12)
    vectors = (random.normal(size=(700, 12)) * 30 * scale @ random.normal(size=(12, 12))).astype(np.float32)
    rows = [(i, [float(c) for c in v], 1, "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    check(whitening.whitened(df), list(vectors), 8)


def test_dependent_constant_and_repeated_dimensions(spark):
    random = np.random.default_rng(2)
    a = random.integers(-50, 50, size=(300, 3)).astype(float)
    vectors = np.column_stack([a, a[:, 0], a[:, 1] * 2, np.full(300, 7.0), np.zeros(300)])
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(vectors)], DDL)
    check(whitening.whitened(df.repartition(3)), list(vectors), 3)


def test_rows_that_are_dropped_repeated_or_short(spark):
    good = [[1.0, 2.0, 3.0], [0.5, -1.0, 2.0], [0.5, -1.0, 2.0], [4.0], [], [-3.0, 1.0, 0.25], [9.0, 9.0, 9.5]]
    bad = [None, [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0], [float("-inf")]]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)] + [(50 + i, v, 1, "x") for i, v in enumerate(bad)]
    check(whitening.whitened(spark.createDataFrame(rows, DDL)), good, 3)
    found = whitening.whitened(spark.createDataFrame([(None, v, 1, "x") for v in good], DDL))
    assert found.count() == 21 and found.filter("vec_id is null").count() == 21


def test_no_variance_and_no_rows(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], 1, "x") for i in range(9)], DDL)
    for rows in (df, df.limit(1), df.limit(0), spark.createDataFrame([(1, [], 1, "x")], DDL)):
        assert whitening.whitened(rows).collect() == []


def test_figures_beyond_a_long_stay_exact():
    at = whitening.Moments(10**9, [3 * 10**14 + 1, 0])
    model = whitening.Whitening(at, np.eye(2), np.ones(2), np.ones(2))
    x = np.array([[1 << 40, -5]])
    assert model.deviation(x) == [(10**9 * (1 << 40) - 3 * 10**14 - 1) ** 2 + (5 * 10**9) ** 2]


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    df = queries.op11_whitening(spark, folder)
    assert dict(df.dtypes)["deviation"] == "bigint"
    given = queries.table(spark, folder, "embeddings").orderBy("vec_id").collect()
    check(df.withColumn("vec_id", F.col("vec_id")), [r.embedding for r in given], 8)
