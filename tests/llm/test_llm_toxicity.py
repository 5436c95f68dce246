import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity

FOLDER = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def best_match(word, terms):
    found = []
    for number, term in enumerate(terms):
        if word.startswith(term):
            found.append((0, -len(term), number))
        elif distance(word, term) <= toxicity.errors_allowed(term):
            found.append((distance(word, term), -len(term), number))
    return min(found, default=(0, 0, -1))


def test_automata_equal_brute_force():
    random = np.random.default_rng(0)
    terms = {t: 1.0 for t in ["scum", "moron", "idiot", "pathetic", "worthless", "äöüßa", "abab", "ababa", "moro"]}
    lexicon = toxicity.Lexicon(terms)
    words = ["", "m", "moron", "morons", "mroon", "morn", "idi0t", "idiiot", "pathetik", "wortless", "wrthles"]
    letters = list("moronidtabscuäö0")
    for _ in range(4000):
        base = list(random.choice(lexicon.terms)) if random.random() < 0.7 else []
        for _ in range(int(random.integers(0, 5))):
            place = int(random.integers(0, len(base) + 1))
            kind = random.integers(0, 3)
            if kind == 0 or not base:
                base.insert(place, random.choice(letters))
            elif place < len(base):
                base[place : place + 1] = [] if kind == 1 else [random.choice(letters)]
        words.append("".join(base))
    words += ["moron" + "x" * 80, "x" * 200]
    term, errors = lexicon.matches([w[: lexicon.longest] for w in words])
    for word, t, e in zip(words, term, errors, strict=True):
        want = best_match(word, lexicon.terms)
        assert (e if t >= 0 else 0, t) == (want[0], want[2]), word


def test_lexicon_without_terms():
    term, errors = toxicity.Lexicon({}).matches(["a", "b"])
    assert term.tolist() == [-1, -1] and errors.tolist() == [0, 0]


@pytest.mark.parametrize(
    "text, plain, quoted",
    [
        ("You are a moron.", True, False),
        ("YOU MORON!", True, False),
        ('She wrote "what a moron he is" in a letter', False, True),
        ("He was called moron by them", False, True),
        ("„a moron”, it reads", False, True),
        ('"yes" moron "no"', True, False),
        ('an inch is 1"\nmoron', True, False),
        ('"an open mark, moron', True, False),
        ("mor*on", True, False),
        ("nothing here", False, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_windows_tell_quotation_from_abuse(text, plain, quoted):
    lexicon = toxicity.Lexicon({"moron": 1.0})
    row = toxicity.features(pa.array([text], pa.string()), lexicon)[0]
    assert (row[:3].sum() > 0, row[5] > 0) == (plain, quoted)


def test_features_do_not_depend_on_neighbours_or_parts():
    lexicon = toxicity.Lexicon({"moron": 2.0, "scum": 1.0, "pathetic": 1.5})
    random = np.random.default_rng(4)
    pool = ["moron", "scumbag", "pathetik", "you", "word", '"quoted', 'end"', "plain", "text\n", "mörön"]
    texts = [" ".join(random.choice(pool, int(n))) for n in random.integers(0, 60, 200)] + ["x moron " * 9000]
    together = toxicity.features(pa.array(texts), lexicon)
    for k, text in enumerate(texts):
        assert np.allclose(together[k], toxicity.features(pa.array([text]), lexicon)[0])


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.scored(docs, labels).toPandas()
    assert rows.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    held = rows[rows.held_out].merge(labels.toPandas(), on="doc_id")
    good, bad = (held.score[held.toxic == t].to_numpy() for t in (1, 0))
    area = np.mean([(good > b).mean() + (good == b).mean() / 2 for b in bad])
    assert area > 0.95 and (held.predicted == held.toxic).mean() > 0.98


def test_labels_held_out_are_never_seen(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = F.when(toxicity.held_out(F.col("doc_id"), 5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    first = sorted(map(tuple, toxicity.scored(docs, labels).collect()))
    again = sorted(map(tuple, toxicity.scored(docs, labels.withColumn("toxic", turned)).collect()))
    assert first == again


def test_sample_is_bounded_whatever_repeats(spark):
    rows = [(7, f"text {i}", "en") for i in range(400)] + [(i, "x", "en") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(7, 1)] * 30 + [(i, i % 2) for i in range(10, 60)], "doc_id long, toxic int")
    found = toxicity.sampled(docs, labels, 5).toPandas()
    assert found.groupby("toxic").size().to_dict() == {0: 5, 1: 5} and found.doc_id.is_unique


def test_copies_do_not_make_terms(spark):
    workers_texts = [(f"the copied message of zanzibar number {'same ' * 9}", 1)] * 60
    other = [(f"plain words about item {i} and thing {i * 7} in the house", 0) for i in range(200)]
    marked = [(f"you total gribble of kind {i} there and {i * 3} here", 1) for i in range(40)]
    examples = spark.createDataFrame(workers_texts + other + marked, "text string, toxic int")
    toxicity.workers.ready(spark)
    weights = toxicity.learned(examples, ())
    assert "gribble" in weights and not any("zanzibar".startswith(t) for t in weights)


@pytest.mark.parametrize("given", [[], [(1, 1)], [(1, None), (None, 0)], [(i, i % 2) for i in range(12)]])
def test_odd_docs(spark, odd_docs, no_docs, given):
    labels = spark.createDataFrame(given, "doc_id long, toxic int")
    rows = toxicity.scored(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    assert toxicity.scored(no_docs, labels).collect() == []


def test_logistic_reaches_the_least_loss():
    random = np.random.default_rng(5)
    x = random.normal(size=(500, 3))
    y = (random.random(500) < 1 / (1 + np.exp(-(x @ [2, -1, 0] - 0.5)))).astype(float)

    def loss(w):
        z = x @ w[:-1] + w[-1]
        ridge = toxicity.RIDGE * np.sqrt(len(x)) * (w[:-1] ** 2).sum() / 2 + 0.5e-6 * w[-1] ** 2
        return np.sum(np.log1p(np.exp(z)) - y * z) + ridge

    w = toxicity.logistic(x, y)
    assert all(loss(w) < loss(w + step) for step in 0.01 * random.normal(size=(50, 4)))
