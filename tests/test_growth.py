"""Steps whose cost per task must not grow with the table: pages, stored vintages, syncs, postings."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import conform
from tidemark.operators import catalog, postings
from tidemark.plans.landing import paged_by_row
from tidemark.sources import files, pages
from tidemark.streaming import sync

ROW = schemas.struct(uuid=schemas.STRING, value=schemas.LONG, known=schemas.ZONELESS)


def test_pages_are_made_where_their_rows_are(spark, tmp_path):
    rows = spark.range(0, 25_300, 1, 2).select(
        F.concat(F.lit('"\n'), "id").alias("uuid"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("value"),
        F.lit(dt.datetime(2020, 1, 1, 1, 2, 3, 456789)).cast("timestamp_ntz").alias("known"),
    )
    request = F.concat(F.lit("r"), (F.length("uuid") % 2).cast("string"))
    landed = paged_by_row(rows, request)
    files.write_page_texts(landed, str(tmp_path / "p"), pages_per_file=7)
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "SortMergeJoin" not in plan
    written = list((tmp_path / "p").glob("*.gz"))
    sizes = [gzip.open(f, "rt").read().count("\n") for f in written]
    assert max(sizes) <= 7 and len(sizes) > 5
    read = pages.read_pages(spark, str(tmp_path / "p"), ROW)
    assert read.agg(F.max(F.size("data"))).first()[0] <= 500
    assert read.where("links.next IS NULL").select("links.self").distinct().count() == 2
    assert [r[0] for r in read.select("count").distinct().collect()] != []
    got = pages.page_rows(read)
    assert got.exceptAll(rows).count() == 0 and got.count() == 25_300
    tables = paged_by_row(rows.limit(3).coalesce(1), F.lit("x"), "lines").collect()
    assert [len(json.loads(r.value)["data"]["lines"]) for r in tables] == [3]


def test_rows_are_conformed_and_failures_marked_in_one_pass(frame):
    schema = schemas.struct(a=schemas.STRING, b=schemas.LONG, c=schemas.DOUBLE, d=schemas.INTS)
    old = frame(
        [("NA", "5.0", "x", "(1, 2)"), (" z ", "word", "y", None), (None, "", "NaN", "[q]")],
        "a string, b string, c string, d string",
    )
    live = frame([("t", 7, 1.5)], "a string, b bigint, c double")
    marked = conform.conform_marked([old, live], schema)
    want = conform.conform_union([old, live], schema)
    assert sorted(map(str, marked.select(*schema.names).collect())) == sorted(map(str, want.collect()))
    failed = {tuple(r) for r in conform.marked_failures(marked).collect()}
    assert failed == {
        (k, r.column_name, r.n_failed)
        for k, df in enumerate((old, live))
        for r in conform.conform_failures(df, schema).collect()
        if r.n_failed
    }
    assert (0, "b", 1) in failed


def test_a_large_landing_comes_in_several_batches(spark, tmp_path):
    target, table = str(tmp_path / "target"), sync.SyncedTable(ROW, ("uuid",), "known")
    for number in range(4):
        rows = [(f"u{i}", i, dt.datetime(2021, 1, 1)) for i in range(number * 50, number * 50 + 100)]
        sync.land(spark.createDataFrame(rows, ROW).coalesce(1), "f", number, target)
    query = sync.keep_new(sync._state_session(spark), target, table, batch_bytes=1)
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [100] * 4
    assert sync.read_target(spark, target, ROW).count() == 250


def test_postings_of_one_small_file_are_made_by_all_tasks(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 1).select("id", F.concat(F.lit("name "), "id").alias("name"))
    spread = postings._spread(rows)
    assert spread.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    path = str(tmp_path / "g")
    postings.write_grams(rows, ["id"], path, buckets=4)
    assert postings.search_substring(rows, path, ["id"], "e 99", buckets=4).count() == 11


def test_runs_of_letters_are_stored_as_lists_of_keys_not_one_row_each(spark, tmp_path):
    rows = spark.range(0, 30_000, 1, 1).select("id", F.concat(F.lit("ababab "), "id").alias("name"))
    path, tasks = str(tmp_path / "g"), postings._spread(rows).rdd.getNumPartitions()
    postings.write_grams(rows, ["id"], path, buckets=4)
    lists = spark.read.parquet(path)
    every = lists.where("term IN ('aba', 'bab', 'ab ')").select("term", F.explode("keys.id").alias("id"))
    assert every.count() == every.distinct().count() == 90_000
    assert every.groupBy("term").count().collect()[0]["count"] == 30_000
    assert lists.agg(F.max(F.size("keys"))).first()[0] <= postings.LIST_KEYS
    assert lists.groupBy("term").count().agg(F.max("count")).first()[0] <= tasks + 30_000 // postings.LIST_KEYS
    assert postings.search_substring(rows, path, ["id"], "BAB 2999", buckets=4).count() == 11


def test_lists_of_keys_hold_odd_texts_and_keys_of_several_columns(spark, tmp_path):
    texts = ["", None, "ab", "\U0001f600\U0001f601x\U0001f600", "é ring" * 300_000, "ring", "x\nrin", "g", "Ring\0ring"]
    rows = spark.createDataFrame(
        [(i % 4 or None, f"k{i}", t) for i, t in enumerate(texts * 2)], "a int, b string, name string"
    )
    path = str(tmp_path / "g")
    postings.write_grams(rows.coalesce(1), ["a", "b"], path, buckets=2)
    for text in ("ring", "\U0001f600\U0001f601X", "gé ri", "\nri", "g\0r", "rinx"):
        want = catalog.search(rows, text).where("a IS NOT NULL")  # a missing key is not looked up
        found = postings.search_substring(rows, path, ["a", "b"], text, buckets=2)
        assert sorted(found.select("b").collect()) == sorted(want.select("b").collect()), text


def test_a_value_is_read_once_and_whole_numbers_by_one_expression(frame):
    schema = schemas.struct(a=schemas.STRING, b=schemas.LONG, c=schemas.LONG, d=schemas.INT, e=schemas.STRINGS)
    old = frame(
        [
            (" NA ", "1.5", "2E1", "3000000000", "['F1', 'F2']"),
            ("x", "-7.0", "99999999999999999999", " 4 ", "()"),
            (None, "NA", "1e-1", None, "NA"),
            ("NaN", "word", "NaN", "", "(it's, \"F3\",)"),
        ],
        "a string, b string, c string, d string, e string",
    )
    marked = conform.conform_marked([old], schema)
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 2 and plan.count("split(") == 1
    got = [tuple(r) for r in marked.select(*schema.names, conform.LOST).collect()]
    assert got == [
        (None, None, 20, None, ["F1", "F2"], "b\nd"),
        ("x", -7, None, 4, None, "c\ne"),
        (None, None, None, None, None, "c"),
        ("NaN", None, None, None, ["it's", "F3"], "b"),
    ]


def test_one_table_is_read_without_a_copy_and_still_strictly(spark, tmp_path):
    rows = spark.range(1200).select(F.col("id").cast("string").alias("uuid"), F.col("id").alias("value"))
    files.write_page_texts(paged_by_row(rows, F.lit("x"), "lines"), str(tmp_path / "p"))
    read = pages.read_tables(spark, str(tmp_path / "p"), {"lines": ROW}, at_once=False)["lines"]
    assert all(str(tmp_path / "p") in f for f in read.inputFiles())
    assert read.select("uuid", "value").exceptAll(rows).count() == 0 and read.count() == 1200
    (tmp_path / "p" / "bad.txt").write_text('{"links": {}, "data": {"lines": [')
    read = pages.read_tables(spark, str(tmp_path / "p"), {"lines": ROW}, at_once=False)["lines"]
    with pytest.raises(Exception, match="unreadable page"):
        read.collect()


def test_lines_of_a_file_are_told_apart_once(frame):
    read = sync.page_bodies(frame([("{}\n \n{}", "f")], "value string, file_path string"))
    assert read._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [r.value for r in read.collect()] == ["{}", "{}"]
