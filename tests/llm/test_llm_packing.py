import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def pieces_of(df):
    return [
        r.asDict() for r in df.withColumn("crc", F.crc32("ids")).drop("ids").collect()
    ]


def check(pieces, docs, window):
    reference = Tokenizer.from_file(PATH)
    wanted, found = Counter(), Counter()
    for doc_id, text in docs:
        ids = reference.encode(text or "", add_special_tokens=False).ids + [1]
        wanted[doc_id, tuple(ids)] += 1
    ids_of = defaultdict(list)
    for key in wanted:
        ids_of[key[0]].append(key[1])
    seen = Counter()
    for p in pieces:
        (ids,) = [i for i in ids_of[p["doc_id"]] if len(i) == p["doc_tokens"]]
        part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == p["crc"]
        for k in range(p["start"], p["start"] + p["length"]):
            seen[p["doc_id"], len(ids), k] += 1
    for (doc_id, ids), times in wanted.items():
        assert all(seen[doc_id, len(ids), k] == times for k in range(len(ids)))
        found[doc_id, ids] = times
    assert sum(seen.values()) == sum(len(k[1]) * n for k, n in found.items())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= window and (end == window or end & (end - 1) == 0)


@pytest.mark.parametrize("window", [16, 2048])
def test_every_id_lies_in_one_piece(odd_docs, texts_of, window):
    check(pieces_of(packing.pack(odd_docs, PATH, window=window, block_tokens=4096)), texts_of, window)


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).collect() == []


def test_window_must_be_a_power_of_two(no_docs):
    with pytest.raises(ValueError):
        packing.pack(no_docs, PATH, window=1000)


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(4)
    for _ in range(50):
        pieces = [(k, 0, rng.randint(1, 32)) for k in range(rng.randint(0, 40))]
        rooms: list[int] = []
        for _, _, length in sorted(pieces, key=lambda p: -p[2]):
            fitting = [r for r in rooms if r >= length]
            rooms.remove(min(fitting)) if fitting else None
            rooms.append((min(fitting) if fitting else 32) - length)
        windows = packing.best_fit(pieces, 32)
        assert sorted(32 - sum(p[2] for p in w) for w in windows) == sorted(rooms)
        assert sorted(p for w in windows for p in w) == sorted(pieces)
        topped = packing.top_up(windows, 32)
        loads = [sum(p[2] for p in w) for w in topped]
        assert sum(loads) == sum(p[2] for p in pieces)
        assert all(x == 32 or x & (x - 1) == 0 for x in loads)


def test_slices_keep_the_tokens():
    encode = packing.encoder(PATH)
    text = "some words and  more   words, 12 34 don't " * 50
    parts = list(packing.slices(text, 100))
    assert len(parts) > 5 and "".join(parts) == text
    assert np.concatenate([encode(p) for p in parts]).tolist() == encode(text).tolist()


def test_another_vocabulary_goes_to_the_library(spark):
    docs = spark.createDataFrame([(1, "Hello there, general")], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = sorted(packing.pack(docs, path, end_id=7).collect(), key=lambda p: p.start)
    ids = Tokenizer.from_file(path).encode("Hello there, general", add_special_tokens=False).ids
    assert np.frombuffer(b"".join(p.ids for p in pieces), "<u4").tolist() == ids + [7]
