"""Sweeps, page gaps, mapping conflicts, paging by rank, versions, digests, postings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, catalog, paging, postings, setops, sweep, versions
from tidemark.sources import pages

PAGE = "links struct<self:string,next:string>, count long, data array<struct<a:int>>"


def page(offset, n, total, following=None, request="u?q=1"):
    link = None if following is None else f"{request}&offset={following}"
    return ((f"{request}&offset={offset}", link), total, [(i,) for i in range(n)])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def many_ranges(spark):
    """Small tables are cut into as many ranges as large ones would be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_reach_of_earlier_rows_over_many_ranges(frame, many_ranges):
    generator = random.Random(1)
    given = [(generator.choice(["a", "b", None, "hot", "hot", "hot"]), i, generator.randint(0, 500)) for i in range(900)]
    generator.shuffle(given)
    df = frame(given, "g string, at int, top int").repartition(7)
    got = {(r.g, r.at): r.reached for r in sweep.with_reach(df, ["g"], ["at"], "top").collect()}
    for g, at, _ in given:
        earlier = [t for h, a, t in given if h == g and a < at]
        assert got[g, at] == max(earlier, default=None)
    ranges = df.repartitionByRange("g", "at").withColumn("r", F.spark_partition_id())
    assert ranges.where("g = 'hot'").select("r").distinct().count() > 1


def test_a_repeated_page_does_not_make_up_for_a_lost_one(frame):
    lost = [page(0, 2, 6, 2), page(0, 2, 6, 2), page(4, 2, 6)]
    whole = [page(0, 2, 6, 2, "v?q"), page(2, 2, 6, 4, "v?q"), page(4, 2, 6, None, "v?q")]
    df = frame(lost + whole, PAGE)
    got = {r.request: (r.n_pages, r.n_rows, r.complete) for r in pages.page_completeness(df).collect()}
    assert got == {"u?q=1": (3, 6, False), "v?q": (3, 6, True)}
    assert rows(pages.page_gaps(df)) == [("u?q=1", "doubled", 0, 2), ("u?q=1", "missing", 2, 4)]


def test_page_gaps_of_every_kind(frame):
    df = frame(
        [
            page(3, 4, 20, 7), page(5, 4, 20, 9), page(12, 0, 20, 12), page(18, 5, 20), page(18, 5, 20),
            page(0, 3, 3, None, "w?"), page(0, 0, 4, None, "none?q"), page(0, 0, 0, None, "empty?q"),
            page(0, 2, None, None, "untold?q"),
        ],
        PAGE,
    )
    assert rows(pages.page_gaps(df)) == sorted(
        [
            ("u?q=1", "missing", 0, 3),
            ("u?q=1", "doubled", 5, 7),
            ("u?q=1", "missing", 9, 18),
            ("u?q=1", "doubled", 18, 23),
            ("u?q=1", "beyond", 20, 23),
            ("none?q", "missing", 0, 4),
        ],
        key=str,
    )
    assert pages.page_gaps(df.limit(0)).collect() == []


def test_gaps_equal_brute_force_on_random_pages(frame, many_ranges):
    generator = random.Random(2)
    given, want = [], set()
    for r in range(30):
        total = generator.randint(0, 60)
        mine = [(generator.randint(0, 70), generator.randint(0, 9)) for _ in range(generator.randint(0, 25))]
        given += [page(low, n, total, None, f"r{r}?x") for low, n in mine]
        if mine:
            seen = {i for low, n in mine for i in range(low, low + n)}
            want |= {(f"r{r}?x", "missing", i) for i in range(total) if i not in seen}
            want |= {(f"r{r}?x", "beyond", i) for i in seen if i >= total}
            want |= {
                (f"r{r}?x", "doubled", i) for i in seen if sum(low <= i < low + n for low, n in mine) > 1
            }
    found = pages.page_gaps(frame(given, PAGE)).collect()
    assert {(r.request, r.kind, i) for r in found for i in range(r.low, r.high)} == want


def test_mapping_conflicts(frame, many_ranges):
    day = dt.date
    df = frame(
        [
            ("k", day(2020, 1, 1), day(2020, 1, 31)), ("k", day(2020, 2, 1), day(2020, 2, 10)),
            ("k", day(2020, 2, 5), day(2020, 2, 20)), ("k", day(2020, 2, 6), day(2020, 2, 7)),
            ("k", day(2020, 3, 1), day(2020, 3, 1)), ("k", day(2020, 3, 1), day(2020, 3, 1)),
            ("x", day(2020, 1, 9), day(2020, 1, 1)), ("y", None, day(2020, 1, 1)), ("z", day(2020, 1, 1), None),
        ],
        "gvk string, effdate date, thrudate date",
    )
    assert rows(asof.mapping_conflicts(df, "gvk")) == sorted(
        [
            ("k", "overlap", day(2020, 2, 5), day(2020, 2, 10)),
            ("k", "overlap", day(2020, 2, 6), day(2020, 2, 7)),
            ("k", "gap", day(2020, 2, 21), day(2020, 2, 29)),
            ("k", "overlap", day(2020, 3, 1), day(2020, 3, 1)),
            ("x", "inverted", day(2020, 1, 9), day(2020, 1, 1)),
        ],
        key=str,
    )


def test_pages_by_rank_at_any_depth(spark, frame):
    generator = random.Random(3)
    given = [(generator.choice([None, "a", "b", "hot", "hot", "hot"]), i) for i in range(1000)]
    df = frame(given, "name string, id int").repartition(9)
    key = ["name", "id"]
    order = sorted(given, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    ranges = paging.key_ranges(df, key, range_rows=40)
    assert ranges.agg(F.sum("n")).first()[0] == 1000 and ranges.count() > 1
    for number in (1, 2, 7, 19, 20, 21, 50):
        page_rows = paging.page_by_number(df, key, number, 50, ranges).collect()
        assert [tuple(r) for r in page_rows] == order[50 * (number - 1) : 50 * number]
    assert [tuple(r) for r in catalog.offset_page(df, key, 995, 50).collect()] == order[995:]
    placed = paging.numbered_pages(df, key, 30).collect()
    assert {(r.name, r.id): (r.position, r.page) for r in placed} == {
        row: (k + 1, k // 30 + 1) for k, row in enumerate(order)
    }
    assert paging.page_by_number(df.limit(0), key, 1).collect() == []
    assert paging.numbered_pages(df.limit(0), key).collect() == []


def test_deep_page_reads_its_key_range(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(0, 100_000).write.parquet(path)
    df = spark.read.parquet(path)
    held = paging.key_ranges(df, ["id"], range_rows=5_000)
    found = paging.page_by_number(df, ["id"], 950, 100, held)
    assert [r.id for r in found.collect()] == list(range(94_900, 95_000))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id," in plan
    assert held.count() == 20 and held.agg(F.max("n")).first()[0] < 10_000


def test_known_at_is_independent_of_order(frame):
    at = [dt.datetime(2020, 1, day) for day in range(1, 9)]
    given = [
        ("a", 1, at[0]), ("a", 2, at[3]), ("a", 3, at[3]), ("a", 4, at[6]), ("b", 1, at[5]), (None, 7, at[1]),
        (None, 8, at[2]), ("c", 1, None),
    ]
    ddl = "uuid string, value int, known timestamp_ntz"

    def known(rows_given, day):
        df = frame(rows_given, ddl).repartition(3)
        return rows(versions.known_at(df, ["uuid"], "known", at[day], tie=["value"]).select("uuid", "value"))

    for order in (given, given[::-1]):
        assert known(order, 0) == [("a", 1)]
        assert known(order, 3) == [("a", 3), (None, 8)]
        assert known(order, 7) == [("a", 4), ("b", 1), (None, 8)]
    df = frame(given + given, ddl)
    assert rows(versions.latest(df, ["uuid"], "known").select("uuid", "value")) == [
        ("a", 4), ("b", 1), ("c", 1), (None, 8)
    ]
    found = {r.uuid: (r.n_versions, r.first_known, r.last_known) for r in versions.restated(df, ["uuid"], "known").collect()}
    assert found == {"a": (4, at[0], at[6]), None: (2, at[1], at[2])}
    documents = df.withColumn("body", F.parse_json(F.lit('{"b": 1, "a": [1, null]}')))
    assert versions.known_at(documents, ["uuid"], "known", at[7]).count() == 3


@pytest.fixture
def documents(spark):
    texts = [(1, '{"a": 1, "b": [1, null]}'), (2, '{"b": 2}'), (2, '{"b": 2}'), (3, None), (None, "7")]
    df = spark.createDataFrame(texts, "uuid int, body string")
    plain = F.create_map(F.lit("x"), F.col("uuid"), F.lit("a"), F.lit(1))
    nested = F.array(F.struct(F.parse_json("body").alias("v")))
    return df.select("uuid", F.parse_json("body").alias("body"), plain.alias("m"), nested.alias("n"))


@pytest.mark.parametrize("diff", [setops.frame_diff, setops.frame_digest_diff])
def test_tables_of_documents_and_maps_are_comparable(spark, documents, diff):
    again = documents.select(
        "uuid",
        F.parse_json(
            F.when(F.col("uuid") == 1, '{"b": [1, null], "a": 1}').otherwise(F.to_json("body"))
        ).alias("body"),
        F.map_from_entries(F.reverse(F.map_entries("m"))).alias("m"),
        "n",
    )
    assert diff(documents, again.repartition(3)).collect() == []
    changed = documents.withColumn("body", F.when(F.col("uuid") == 2, F.parse_json(F.lit("3"))).otherwise(F.col("body")))
    found = diff(documents, changed)
    assert found.schema["body"].dataType == documents.schema["body"].dataType
    assert found.schema["m"].dataType == documents.schema["m"].dataType
    got = sorted((r.uuid, str(r.body), r.n_left, r.n_right) for r in found.collect())
    assert [(u, a, b) for u, _, a, b in got] == [(2, 0, 2), (2, 2, 0)]
    other = documents.withColumn("body", F.to_json("body"))
    assert diff(documents, other).count() == 4 + 4
    assert setops.frames_equal(documents, again) and not setops.frames_equal(documents, changed)
    assert setops.frames_digest_equal(documents, again) and not setops.frames_digest_equal(documents, changed)
    assert not setops.frames_digest_equal(documents, other)


def test_digest_diff_equals_diff_and_shuffles_digests_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).select((F.col("id") % 7_000).alias("k"), (F.col("id") % 3).alias("v")).write.parquet(path)
    left = spark.read.parquet(path)
    right = left.withColumn("v", F.when(F.col("k") == 77, 9).otherwise(F.col("v")))
    for buckets in (1, 16, 4096):
        assert rows(setops.frame_digest_diff(left, right, buckets)) == rows(setops.frame_diff(left, right))
    assert setops.frame_digest_diff(left, left).collect() == []
    digests = setops.bucket_digests(left, 16)
    assert digests.count() == 16 and digests.agg(F.sum("n_rows")).first()[0] == 20_000
    plan = setops.differing_buckets(left, left, 16)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and all("bucket" in line for line in exchanged)
    one = left.unionByName(left.where("k = 1").limit(1))
    assert not setops.frames_digest_equal(left, one)


def test_keyword_postings_equal_the_scan(spark, tmp_path, frame):
    from tidemark.functions import keywords

    df = frame(
        [(1, "Blue ring-finger"), (2, "blue BLUE sea"), (3, None), (4, ""), (5, "the ring"), (5, "the ring"), (6, "x")],
        "id int, text string",
    )
    path = str(tmp_path / "p")
    postings.write_keywords(df.distinct(), ["id"], "text", path, 8)
    for phrase in ("ring", "blue ring", ["the sea", "x"], "absent"):
        want = keywords.keyword_matches(df.distinct(), "text", phrase).select("id", "score", "n_tokens")
        assert rows(postings.search_keywords(spark, path, ["id"], phrase, 8)) == rows(want)
    plan = postings.search_keywords(spark, path, ["id"], "ring", 8)._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert all(postings.bucket_of(t, 8) == b for t, b in spark.read.parquet(path).select("term", "bucket").distinct().collect())


def test_substring_postings_equal_the_scan(tmp_path, frame):
    df = frame(
        [(1, "Blue Ring", "wood"), (2, "bl", None), (3, None, "ue ring"), (4, "ringing ring", "x"), (5, "äöü ring", "")],
        "id int, name string, unit string",
    )
    path = str(tmp_path / "g")
    postings.write_grams(df, ["id"], path, buckets=8)
    for text in ("ring", "RING", "ue r", "g wood", "bl", "r", "", "ringi", "öü ", "gnir"):
        found = postings.search_substring(df, path, ["id"], text, buckets=8)
        assert rows(found) == rows(catalog.search(df, text)), text


def test_na_is_no_value_on_the_way_to_a_stored_table(frame):
    from tidemark import schemas
    from tidemark.functions import conform

    schema = schemas.struct(a=schemas.STRING, b=schemas.LONG, c=schemas.DOUBLE, d=schemas.DAY)
    df = frame(
        [("NA", "NA", "NA", "NA"), (" NA ", "5.0", "x", "2020-01-01"), ("NAB", "", " ", "")],
        "a string, b string, c string, d string",
    )
    got = [tuple(r) for r in conform.conform(df, schema).collect()]
    assert got == [(None,) * 4, (None, 5, None, dt.date(2020, 1, 1)), ("NAB", None, None, None)]
    failed = {r.column_name: r.n_failed for r in conform.conform_failures(df, schema).collect()}
    assert failed == {"a": 0, "b": 0, "c": 1, "d": 0}
