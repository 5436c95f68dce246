import datetime as dt

import pytest

from tidemark.session import shared_folder
from tidemark.sources.tables import exists
from tidemark.streaming import marks

DDL = "key string, at timestamp_ntz, value int"
KEYS = ["key"]


def at(day):
    return dt.datetime(2024, 1, day)


def names(df):
    return sorted((r.key or "", r.value) for r in df.collect())


@pytest.fixture
def target(spark):
    return shared_folder(spark, "marks-test")


def test_ties_of_the_mark_are_loaded_once_and_only_once(frame, target, spark):
    first = [("a", at(1), 1), ("b", at(2), 2), ("c", at(2), 3)]
    later = [("d", at(2), 4), (None, at(2), 5), ("e", at(3), 6), ("late", at(1), 7)]
    source = frame(first, DDL)
    whole = frame(first + later, DDL)
    loads = [marks.load_once(df, "at", KEYS, target) for df in (source, whole, whole)]
    added = [names(marks.read_load(spark, target, source.schema, n)) for n in loads]
    assert added == [[("a", 1), ("b", 2), ("c", 3)], [("", 5), ("d", 4), ("e", 6)], []]
    assert len(marks.read_loaded(spark, target, source.schema).collect()) == 6


def test_ties_that_come_in_turn_add_up_in_the_mark(frame, target, spark):
    rows = [(k, at(5), i) for i, k in enumerate("abc")] + [(None, at(5), 9)]
    for n in range(1, 5):
        marks.load_once(frame(rows[:n], DDL), "at", KEYS, target)
    found = marks.read_loaded(spark, target, frame(rows, DDL).schema)
    assert names(found) == sorted((k or "", v) for k, _, v in rows)


def test_no_rows_no_mark(frame, target, spark):
    empty = frame([], DDL)
    marks.load_once(empty, "at", KEYS, target)
    assert marks.read_loaded(spark, target, empty.schema).count() == 0
    full = frame([("a", at(1), 1), ("without an instant", None, 2)], DDL)
    assert names(marks.rows_beyond(full, "at", KEYS, marks.mark_after(empty, "at", KEYS))) == [("a", 1)]
    marks.load_once(full, "at", KEYS, target)
    marks.load_once(empty, "at", KEYS, target)  # leaves the mark as it was
    marks.load_once(full, "at", KEYS, target)
    assert names(marks.read_loaded(spark, target, full.schema)) == [("a", 1)]


def test_a_load_that_broke_off_is_done_again(frame, target, spark):
    rows = frame([("a", at(1), 1)], DDL)
    rows.write.parquet(f"{target}/{marks.ROWS}/{marks.LOAD}-0")  # rows, but no mark
    assert marks.read_loaded(spark, target, rows.schema).count() == 0
    assert marks.load_once(rows, "at", KEYS, target) == 0
    assert names(marks.read_loaded(spark, target, rows.schema)) == [("a", 1)]
    assert exists(spark, f"{target}/{marks.MARKS}/{marks.LOAD}-0/_SUCCESS")


def test_keys_of_several_columns_and_copies(frame, target, spark):
    rows = [("a", at(1), 1), ("a", at(1), 2), ("a", at(1), None)]
    marks.load_once(frame(rows[:1], DDL), "at", ["key", "value"], target)
    marks.load_once(frame(rows + rows, DDL), "at", ["key", "value"], target)
    found = [r.value for r in marks.read_loaded(spark, target, frame(rows, DDL).schema).collect()]
    assert sorted(found, key=str) == [1, 2, 2, None, None]


def test_both_filters_reach_the_scan_and_only_ties_meet_the_mark(spark, target, frame):
    rows = frame([(str(i), at(1 + i % 9), i) for i in range(90)], DDL)
    path = shared_folder(spark, "marks-source")
    rows.write.parquet(path)
    source = spark.read.parquet(path)
    mark = marks.mark_after(source.where("value < 45"), "at", KEYS)
    found = marks.rows_beyond(source, "at", KEYS, mark)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at,ScalarSubquery" in plan and "EqualTo(at,ScalarSubquery" in plan
    assert names(found) == [(str(i), i) for i in (53, 62, 71, 80, 89)]
