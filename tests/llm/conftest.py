import pytest

LONG = " ".join(f"w{i % 5003}x{i % 977}" for i in range(60_000))
PASSAGE = " ".join(f"common{i}" for i in range(60))
CLASHING = (
    "size long, key string, sig string, bits int, bucket string, copies string, doc string,"
    " target string, rate string, list string, tile string, spans string, held_out string,"
    " statistics string, places string, score string, component_id string"
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty, blank, very long, equal and repeated ones."""
    rows = [
        (1, "one two three four five six seven", "en", "a", 33),
        (2, "One TWO three four five six seven", "en", "a", 33),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n\x0b\x0c\r ", "de", "b", 7),
        (6, LONG, "en", "b", len(LONG)),
        (7, LONG + " end", "en", None, len(LONG) + 4),
        (8, "short", "fr", "c", 5),
        (8, "short", "fr", "c", 5),
        (None, "a row without an id that has some words to it", "en", "c", None),
        (None, None, None, None, None),
        (9, f"before {PASSAGE} after", "en", "d", None),
        (10, f"other start {PASSAGE} other end", "es", "d", None),
        (11, "déjà vu, ça va? — naïve Ünïcödé 日本語 <|endoftext|> x", "fr", "a", None),
        (-12, "negative id " + "again " * 90, "en", "é", None),
    ]
    extra = (7, "k", "k", 3, "k") + ("k", None) * 6
    return spark.createDataFrame(
        [r + extra for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING,
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def texts_of(odd_docs):
    return [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
