import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, quality

FOLDER = "/root/testdata/sf0.01"


def out(doc_id, parts, part):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == part


def area(good, bad):
    return np.mean([(good > b).mean() + (good == b).mean() / 2 for b in bad])


def test_quality_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = quality.scored(docs, labels).toPandas()
    assert rows.held_out.tolist() == [out(i, 3, 1) for i in rows.doc_id]
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    held = rows[rows.held_out].merge(labels.toPandas(), on="doc_id")
    good, bad = (held.score[held.quality == q].to_numpy() for q in (1, 0))
    assert len(bad) > 10 and area(good, bad) > 0.97 and ((held.quality == held.predicted).mean()) > 0.95
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(rows.doc_id[rows.predicted == 1])


def test_labels_held_out_are_never_seen(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").join(docs.select("doc_id"), "doc_id")
    turned = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id"), 3, 1), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    first = sorted(map(tuple, quality.scored(docs, labels).collect()))
    again = sorted(map(tuple, quality.scored(docs, turned).collect()))
    assert np.allclose([r[2] for r in first], [r[2] for r in again], atol=1e-9)


@pytest.mark.parametrize("given, score", [([], 0.5), ([(1, 1)], 1.0), ([(1, None), (None, 0)], 0.5)])
def test_quality_without_both_kinds_of_labels(spark, odd_docs, given, score):
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    assert not out(1, 3, 1)
    rows = quality.scored(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and {r.score for r in rows} == {score}
    assert quality.accepted(odd_docs, labels).schema == odd_docs.schema


def test_quality_of_odd_docs(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(i, int(i % 2)) for i in range(20)] * 2 + [(3, None)], "doc_id long, quality int"
    )
    rows = quality.scored(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.scored(no_docs, labels).collect() == []


def test_isotonic_is_the_nearest_rising_fit():
    rng = np.random.default_rng(0)
    totals = rng.integers(1, 9, 30).astype(float)
    hits = np.minimum(totals, rng.integers(0, 9, 30)).astype(float)
    fit = quality.isotonic(hits, totals)
    assert (np.diff(fit) >= -1e-12).all() and abs((fit * totals).sum() - hits.sum()) < 1e-9
    rate = hits / totals  # the fit is max over i of min over j of the mean of i..j
    wanted = [
        max(
            min(hits[i : j + 1].sum() / totals[i : j + 1].sum() for j in range(k, 30))
            for i in range(k + 1)
        )
        for k in range(30)
    ]
    assert np.allclose(fit, wanted) and len(rate) == 30


def test_statistics_see_the_whole_text():
    plain = "some words in a row. " * 3000
    a, b = quality.statistics(pa.array([plain, plain[:-2] + " ### $$$ LOUD!!"]))
    assert not np.array_equal(a, b)
    assert not quality.statistics(pa.array([None, "", " \n"], pa.string())).any()


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = langid.predicted(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert rows.held_out.tolist() == [out(i, 5, 0) for i in rows.doc_id]
    assert rows.score.between(0, 1).all()
    held = rows[rows.held_out]
    assert len(held) > 150 and (held.lang == held.lang_pred).mean() > 0.97


def test_languages_of_odd_docs(odd_docs, no_docs):
    found = langid.predicted(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found}
    for doc_id in (3, 4, 5):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert {by_id[i].lang_pred for i in (1, 6, 8, 11)} <= {"en", "fr", "de", "es"}
    assert langid.predicted(no_docs).collect() == []
    unknown = langid.predicted(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_letters_of_any_script():
    content = "12 ?!|日本|é|—…|a".encode()
    offsets = np.array([0, *[i + 1 for i, b in enumerate(content) if b == ord("|")], len(content)])
    assert langid._has_letter(content_array(content), offsets).tolist() == [False, True, True, False, True]


def content_array(raw):
    return np.frombuffer(raw, np.uint8)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    layer = langid.Direction(rng, 5)
    layer.bytes, layer.back = layer.bytes.astype(np.float64), layer.back.astype(np.float64)
    x, aim = rng.integers(0, 4, (6, 3)), rng.normal(size=(6, 3, 5))

    def run():
        h, kept, after = np.zeros((3, 5)), [], []
        for now in x:
            z, r, c, past, new = layer.step(now, h)
            kept.append((h, z, r, c, past))
            after.append(new)
            h = new
        return kept, np.stack(after)

    kept, after = run()
    table, back = layer.learn(x, kept, aim)
    for weights, gradient, index in ((layer.bytes, table, (2, 1, 3)), (layer.back, back, (1, 2, 4)), (layer.bytes, table, (0, 2, 0)), (layer.back, back, (2, 0, 1))):
        value, step = weights[index], 1e-4
        weights[index] = value + step
        high = (run()[1] * aim).sum()
        weights[index] = value - step
        low = (run()[1] * aim).sum()
        weights[index] = value
        assert abs((high - low) / (2 * step) - gradient[index]) < 1e-3


def test_a_repeated_id_keeps_the_sample_bounded(spark):
    rows = [(1, f"text number {i} of one id", "en") for i in range(3000)]
    rows += [(1, "texte", "fr")] * 40 + [(i, "autre texte", "fr") for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.examples(docs, per_language=8)
    per = {lang: sum(1 for x, _ in found if x == lang) for lang in ("en", "fr")}
    assert 0 < per["en"] <= langid.SEGMENTS_PER_DOC and 8 <= per["fr"] <= 8 * langid.SEGMENTS_PER_DOC


def test_pooled_labels_equal_a_walk_byte_by_byte():
    rng = np.random.default_rng(7)
    net = langid.Network(["a", "b", "c"], langid.Direction(rng, 6), langid.Direction(rng, 6))
    net.out = [rng.normal(size=(6, 3)).astype(np.float32) for _ in range(2)] + [np.ones(3, np.float32)]
    given = [b"", b"x", b"some text", bytes(rng.integers(0, 256, langid.SEGMENT * 2 + 5, dtype=np.uint8))]
    given.append(bytes(rng.integers(0, 256, langid.SEGMENT, dtype=np.uint8)))

    def walk(layer, data):
        h, states = np.zeros((1, 6), np.float32), []
        for byte in data:
            h = layer.step(np.array([byte]), h)[-1]
            states.append(h[0])
        return states

    want = []
    for raw in given:
        total = np.zeros(3)
        for at in range(0, len(raw), langid.SEGMENT):
            piece = raw[at : at + langid.SEGMENT]
            ahead, behind = walk(net.forward, piece), walk(net.backward, piece[::-1])[::-1]
            for f, b in zip(ahead, behind, strict=True):
                z = np.exp(f @ net.out[0] + b @ net.out[1] + net.out[2])
                total += z / z.sum()
        want.append(total / max(len(raw), 1))
    offsets = np.cumsum([0, *map(len, given)])
    got = net.pooled(content_array(b"".join(given)), offsets)
    assert np.allclose(got, want, atol=1e-4)


def test_fit_solves_the_ridge_equations(spark):
    rng = np.random.default_rng(8)
    given = rng.normal(size=(400, quality.STATISTICS))
    marks = (given[:, 0] + given[:, 1] * given[:, 2] > 0).astype(float)
    rows = [(r.tobytes(), float(q)) for r, q in zip(given, marks, strict=True)]
    quality.workers.ready(spark)
    model = quality.fit(spark.createDataFrame(rows, "statistics binary, quality double").repartition(5), fourier=32)
    assert np.allclose(model.mean, given.mean(axis=0)) and np.allclose(model.scale, given.std(axis=0))
    z = model.features(given)
    ridge = quality.RIDGE * len(given) / 32 * np.eye(33)
    ridge[-1, -1] = 0
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + ridge, z.T @ marks), atol=1e-6)
    bins = np.minimum((np.clip((z @ model.weights + 0.5) / 2, 0, 1) * quality.BINS).astype(int), quality.BINS - 1)
    held = np.unique(bins)
    hits = np.array([marks[bins == b].sum() for b in held])
    want = quality.isotonic(hits, np.array([(bins == b).sum() for b in held], float))
    assert np.allclose(model.steps[1], want)
