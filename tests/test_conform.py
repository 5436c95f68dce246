import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import conform, keywords, text


def test_vintages_of_holdings_conform(frame):
    historical = frame(
        [
            ("u1", "c1", "1091.0", "", "", "349.0"),
            ("u2", "c1", "1124.0", "(43,)", "Put", "0.0"),
            ("u3", "c1", "9007199254740993.0", "(2, 3)", "", ""),
        ],
        "uuid string, cusip string, ssh_prnamt string, other_manager string, put_call string, value string",
    )
    live = frame(
        [("u4", "c2", 1086131, None, None), ("u5", "c2", 1, [0], 7), ("u6", "c2", 2, [1, 2, 3], 8)],
        "uuid string, cusip string, ssh_prnamt int, other_manager array<bigint>, value bigint",
    )
    united = conform.conform_union([historical, live], schemas.INFORMATION_TABLE)
    assert united.schema.names == schemas.INFORMATION_TABLE.names
    assert [f.dataType for f in united.schema] == [f.dataType for f in schemas.INFORMATION_TABLE]
    got = {
        r["uuid"]: (r["ssh_prnamt"], r["other_manager"], r["put_call"], r["value"])
        for r in united.collect()
    }
    assert got == {
        "u1": (1091, None, None, 349),
        "u2": (1124, [43], "Put", 0),
        "u3": (9007199254740993, [2, 3], None, None),
        "u4": (1086131, None, None, None),
        "u5": (1, [0], None, 7),
        "u6": (2, [1, 2, 3], None, 8),
    }


def test_typed_columns_and_failures(frame):
    rows = frame(
        [("1.5", "7", "2020-01-02T03:04:05-05:00"), ("", "NA", "NA"), ("x", "y", "never")],
        "item_value string, gvk string, at string",
    )
    casts = {"item_value": "double", "gvk": "bigint", "at": "timestamp"}
    good, blank, bad = conform.typed_columns(rows, casts).collect()
    assert (good["item_value"], good["gvk"]) == (1.5, 7)
    assert good["at"].astimezone(dt.timezone.utc).hour == 8
    assert tuple(blank) == tuple(bad) == (None, None, None)
    failures = {r["column_name"]: r["n_failed"] for r in conform.cast_failures(rows, casts).collect()}
    assert failures == {"item_value": 1, "gvk": 1, "at": 1}
    with pytest.raises(PySparkException):
        conform.typed_columns(rows, casts, strict=True).collect()


def test_keys_pad_and_unpad(frame):
    row = frame([(33115, 12345678901)], "a bigint, b bigint").select(
        conform.pad_key("a", 10), conform.pad_key("b", 10), conform.unpad_key(F.lit("0000033115"))
    ).first()
    assert tuple(row) == ("0000033115", "12345678901", 33115)


def test_iso_conformance(frame):
    rows = frame(
        [("2020-01-01T00:00:00-05:00", "2020-01-01"), (None, "2020-13-01T00:00:00")], "a string, b string"
    )
    got = {r["column_name"]: tuple(r)[1:] for r in conform.iso_conformance(rows, "a", "b").collect()}
    assert got == {"a": (True, 0), "b": (False, 2)}


def test_keyword_search_ranks_by_tokens_held(frame):
    items = frame(
        [
            ("IVSTCH_YEAR", "Short-Term Investments - Change"),
            ("CHE_QUARTER", "Cash and Short-Term Investments"),
            ("ALTO_QUARTER", "Other Long-term Assets"),
            ("ACT_QUARTER", "Current Assets - Total"),
            ("DLTT_QUARTER", "Long-Term Debt - Total"),
            ("SHORTY", "Shorter terms"),
        ],
        "item string, description string",
    )
    for asked in ("short-term short term", ["Short", "TERM short"]):
        found = [r["item"] for r in keywords.search_items(items, asked).collect()]
        assert found[:2] == ["IVSTCH_YEAR", "CHE_QUARTER"]
        assert set(found[2:]) == {"ALTO_QUARTER", "DLTT_QUARTER"}
    with pytest.raises(ValueError):
        keywords.query_tokens(" - ")


def test_text_cleaning(frame):
    rows = frame([(1, "  a \t b\n\n  \nc\\nd  \n")], "id int, txt string")
    assert rows.select(text.tidy_lines("txt")).first()[0] == "a b\nc\\nd"
    lines = text.explode_lines(rows, "txt")
    assert lines.count() == 5
    assert [r["line"] for r in text.clean_lines(lines).orderBy("line_no").collect()] == ["a b", "c\\nd"]
    kept = text.drop_lines(lines, r"^\s*$")
    assert kept.count() == 2 and text.drop_lines(lines, None).count() == 5


def test_whole_numbers_read_and_fractions_are_counted(frame):
    texts = ["1091", "1091.0", " -7. ", "1091.9", "1.5E3", "1.5E0", "x", "", None, "9007199254740993.0", "3000000000"]
    rows = frame([(t, t) for t in texts], "a string, b string")
    schema = schemas.struct(a=schemas.LONG, b=schemas.INT)
    got = conform.conform(rows, schema).collect()
    assert [r["a"] for r in got] == [
        1091, 1091, -7, None, 1500, None, None, None, None, 9007199254740993, 3000000000,
    ]
    assert [r["b"] for r in got][-2:] == [None, None] and got[0]["b"] == 1091
    failed = {r[0]: r[1] for r in conform.conform_failures(rows, schema).collect()}
    assert failed == {"a": 3, "b": 5}
    doubles = frame([(1.5,), (2.0,), (float("nan"),)], "a double")
    assert [r[0] for r in conform.conform(doubles, schemas.struct(a=schemas.LONG)).collect()] == [None, 2, None]
    assert conform.conform_failures(doubles, schemas.struct(a=schemas.LONG)).first()["n_failed"] == 1


def test_null_tokens_of_unlisted_columns(frame):
    rows = frame([("NA", "NA", 1), ("2", "x", 2)], "n string, t string, k int")
    got = conform.typed_columns(rows, {"n": "int"}).collect()
    assert [tuple(r) for r in got] == [(None, None, 1), (2, "x", 2)]
