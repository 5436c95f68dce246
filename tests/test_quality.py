import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile, quality, setops


def test_duplicates(frame):
    rows = frame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "d")], "k int, v string")
    assert sorted(tuple(r) for r in quality.duplicate_rows(rows, "k").collect()) == [
        (1, "a"), (1, "b"), (3, "d"), (3, "d"),
    ]
    assert {tuple(r) for r in quality.duplicated_values(rows, "k").collect()} == {(1, 2), (3, 2)}
    assert quality.duplicated_values(rows.distinct(), "v").count() == 0
    gaps = frame([(None, "a"), (None, "a"), (None, "b"), (1, None), (1, None)], "k int, v string")
    assert sorted(map(str, quality.duplicate_rows(gaps, "k", "v").collect())) == [
        "Row(k=1, v=None)", "Row(k=1, v=None)", "Row(k=None, v='a')", "Row(k=None, v='a')",
    ]


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_monotonic_violations_equal_brute_force(spark, frame, ranges):
    """One series holds a third of the rows and spans many ranges."""
    rng = random.Random(ranges)
    rows = [("hot" if i % 3 == 0 else f"s{rng.randrange(5)}", i, rng.randrange(4)) for i in range(900)]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = frame(rows, "s string, pos int, v int")
        got = quality.monotonic_violations(df, ["s"], ["pos"], "v").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = {}
    for name in {r[0] for r in rows}:
        values = [v for _, _, v in sorted((r for r in rows if r[0] == name), key=lambda r: r[1])]
        pairs = list(zip(values, values[1:]))
        expected[name] = (len(values), sum(b < a for a, b in pairs), sum(b == a for a, b in pairs))
    assert {r["s"]: tuple(r)[1:] for r in got} == expected


@pytest.mark.parametrize("ranges", [1, 5])
def test_falls_across_missing_values(spark, frame, ranges):
    values = {"a": [5, None, 3, None, None, 3, 4], "b": [None, None], "c": [None, 2, None, 1, None]}
    rows = [(s, i, v) for s, held in values.items() for i, v in enumerate(held)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = quality.monotonic_violations(frame(rows, "s string, pos int, v int"), ["s"], ["pos"], "v")
        got = {r["s"]: tuple(r)[1:] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {"a": (7, 1, 1), "b": (2, 0, 0), "c": (5, 1, 0)}


def test_range_missing_and_allowed(frame):
    rows = frame([(1, "a"), (5, None), (None, "z")], "k int, v string")
    row = quality.range_conformance(rows, "k", F.lit(1), F.lit(5)).first()
    assert tuple(row) == (1, 5, 1, False)
    empty = quality.range_conformance(rows.limit(0), "k", F.lit(1), F.lit(5)).first()
    assert empty["conforms"] is True
    got = {r["column_name"]: (r["n_missing"], r["met"]) for r in quality.unexpected_missing(rows, {"k": 0, "v": 1}).collect()}
    assert got == {"k": (1, False), "v": (1, True)}
    allowed = frame([("a",), ("a",)], "x string")
    assert [tuple(r) for r in quality.not_allowed_values(rows, "v", allowed).collect()] == [("z", 1)]


def test_types(frame):
    rows = frame([("1", 1, 1), ('"x"', 2, 2)], "j string, a int, b bigint")
    assert not quality.type_agreement(rows, rows, "a", "b")
    assert quality.type_agreement(rows, rows, "a", "a")
    types = quality.variant_types(rows.select(F.parse_json("j").alias("j")), "j")
    assert {tuple(r) for r in types.collect()} == {("BIGINT", 1), ("STRING", 1)}


def test_profiles(frame):
    rows = frame([("a", 1), ("b", 1), ("a", None)], "k string, v int")
    assert {tuple(r) for r in profile.column_profile(rows).collect()} == {
        ("k", 2, "a", "b", 0, 3), ("v", 1, "1", "1", 1, 3),
    }
    assert {tuple(r) for r in profile.column_values(rows, "v").collect()} == {("v", "1", 2), ("v", None, 1)}
    assert {tuple(r) for r in profile.distinct_counts(rows, "k", "v").collect()} == {("k", 2), ("v", 1)}
    assert {tuple(r) for r in profile.facet_profile(rows, "k", "v").collect()} == {
        ("k", "a", 2), ("k", "b", 2), ("v", "1", 1),
    }
    many = frame([(f"v{i}",) for i in range(1500)], "k string")
    assert profile.facet_profile(many, "k").count() == 1500
    numbers = frame([(9, 1.5), (10, float("nan")), (None, None)], "v int, d double")
    assert {tuple(r) for r in profile.column_profile(numbers).collect()} == {
        ("v", 2, "9", "10", 1, 3), ("d", 1, "1.5", "1.5", 2, 3),
    }
    assert profile.column_profile(numbers.where("v < 0"), "v").first()["n_distinct"] == 0
    assert tuple(profile.corner_values(rows, "v").first()) == (1, 1)
    assert profile.row_count(rows).first()[0] == 3


def test_set_comparisons_equal_brute_force(frame):
    rng = random.Random(3)
    left = [(rng.randrange(30), rng.choice("ab")) for _ in range(60)] + [(7, "a")] * 40
    right = [(rng.randrange(40), rng.choice("ab")) for _ in range(60)]
    a, b = frame(left, "k int, v string"), frame(right, "k int, v string")
    ks, kt = {k for k, _ in left}, {k for k, _ in right}
    row = setops.set_diff_report(a, b, "k").first()
    assert tuple(row) == (len(ks), len(kt), len(ks & kt), len(ks - kt), len(kt - ks))
    assert {r[0] for r in setops.difference(a, b, "k").collect()} == ks - kt
    assert {r[0] for r in setops.intersection(a, b, "k").collect()} == ks & kt
    sides = {(r["k"], r["side"]) for r in setops.reconcile(a, b, "k").collect()}
    assert sides == {(k, "left_only") for k in ks - kt} | {(k, "right_only") for k in kt - ks}
    ca, cb = Counter(left), Counter(right)
    diff = {((r["k"], r["v"]), r["n_left"], r["n_right"]) for r in setops.frame_diff(a, b).collect()}
    assert diff == {(x, ca[x], cb[x]) for x in ca | cb if ca[x] != cb[x]}
    assert setops.frame_diff(a, a).count() == 0
    assert tuple(setops.set_relations(a, a, "k").first()) == (True, True, False)


def test_fuzzy_and_ordered(frame):
    a = frame([(1, " x  y\n"), (2, "z")], "k int, v string")
    b = frame([(1, "x y"), (2, "zz")], "k int, v string")
    assert setops.frame_diff(a, b, fuzzy=True).count() == 2
    c, d = frame([("a\n\n b ",)], "v string"), frame([("a b",)], "v string")
    assert setops.frame_diff(c, d, fuzzy=True).count() == 2
    assert setops.frames_equal(c, frame([("a\nb",)], "v string"), fuzzy=True)
    more = a.withColumn("x", F.lit(None).cast("int"))
    assert setops.frame_diff(a, more).count() == 4 and not setops.frames_equal(a.limit(0), more.limit(0))
    assert [tuple(r) for r in setops.schema_diff(a, more).collect()] == [("x", None, "int")]
    other = a.withColumn("k", F.col("k").cast("bigint"))
    assert setops.frame_diff(a, other).count() == 4 and not setops.frames_equal(a, other)
    assert setops.frames_equal(a, other, fuzzy=True) and setops.frames_equal(a, a.select("v", "k"))
    got = {tuple(r) for r in setops.ordered_diff(a, b, ["k"], "v").collect()}
    assert got == {(1, " x  y\n", "x y"), (2, "z", "zz")}
    longer = b.unionAll(frame([(3, None)], "k int, v string"))
    assert [tuple(r) for r in setops.ordered_diff(b, longer, ["k"], "v").collect()] == [(3, None, None)]
    united = setops.union_by_name([a.select("k"), b])
    assert united.columns == ["k", "v"] and united.count() == 4
