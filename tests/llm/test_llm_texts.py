import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import texts

ALPHABET = st.text(alphabet="abé \t\n\x0b\x0c\r本", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), ALPHABET), max_size=6))
def test_words_are_those_of_split(found):
    content, offsets = texts.flat(pa.array(found, pa.string()))
    hashes, starts, ends, first = texts.words(content, offsets)
    names = {}
    for k, text in enumerate(found):
        wanted = (text or "").encode().split()
        spans = [content[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        assert spans[first[k] : first[k + 1]] == wanted
        for word, name in zip(wanted, hashes[first[k] : first[k + 1]], strict=True):
            assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("length", [1, 7, 8, 9, 63, 64, 65, 1024, 1025, 5000])
def test_long_words_are_told_apart(length):
    content, offsets = texts.flat(pa.array(["a" * length + " " + "a" * (length - 1) + "b"]))
    hashes = texts.words(content, offsets)[0]
    assert hashes[0] != hashes[1]


def test_sliced_columns_and_parts():
    column = pa.array(["x", "ab cd", None, "", "e"]).slice(1, 3)
    content, offsets = texts.flat(column)
    assert content.tobytes() == b"ab cd" and offsets.tolist() == [0, 5, 5, 5]
    assert list(texts.parts(np.array([0, 5, 30, 31, 32]), 10)) == [(0, 1), (1, 2), (2, 4)]
    assert list(texts.parts(np.array([0]))) == []


def test_ngrams_depend_on_order():
    a, b = texts.ngrams(np.array([1, 2, 3], np.uint64), 3), texts.ngrams(np.array([3, 2, 1], np.uint64), 3)
    assert a != b and len(texts.ngrams(np.array([1], np.uint64), 2)) == 0
