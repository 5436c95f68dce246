import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import payloads
from tidemark.store import FilingStore

DAY = dt.date(2020, 1, 2)


@pytest.fixture
def metadata(frame):
    return frame(
        [
            ("u1", 1, "4", DAY, dt.datetime(2020, 2, 1)),
            ("u2", 2, "4", dt.date(2020, 1, 3), dt.datetime(2020, 2, 1)),
            ("u3", 1, "13F-HR", DAY, dt.datetime(2020, 2, 1)),
            ("u4", 2, "13F-HR", DAY, dt.datetime(2020, 2, 1)),
        ],
        "uuid string, cik bigint, form_type string, filing_date date,"
        " form_availability_timestamp timestamp",
    )


def uuids(df):
    return sorted(r["uuid"] for r in df.collect())


def test_insider_payload_keeps_every_table(frame, metadata):
    child = "uuid string, footnote_ids array<string>"
    tables = {
        "metadata": metadata,
        "derivative_table": frame([], child),
        "footnotes": frame([("u1", "F1", "a"), ("u2", "F1", "b")], "uuid string, footnote_id string, footnote string"),
        "general_info": frame([("u1", []), ("u3", [])], child),
        "non_derivative_table": frame([("u1", ["F1"]), ("u1", []), ("u2", None)], child),
        "reporting_owner_info": frame([("u2", [])], child),
    }
    store = FilingStore(insider=tables)
    found = store.get_form4_payload(
        cik=1, start_datetime="2020-01-02T00:00:00+00:00", date_mode="publication_date"
    )
    assert list(found) == list(tables)
    kept = payloads.insider_payload(tables, keep_parent=True, cik=1)
    assert {n: uuids(df) for n, df in kept.items()} == {n: uuids(df) for n, df in found.items()}
    assert {name: uuids(df) for name, df in found.items()} == {
        "metadata": ["u1"],
        "derivative_table": [],
        "footnotes": ["u1"],
        "general_info": ["u1"],
        "non_derivative_table": ["u1", "u1"],
        "reporting_owner_info": [],
    }


def test_holdings_by_filer_and_by_security(frame, metadata):
    tables = {
        "metadata": metadata,
        "header_data": frame([("u3", 1), ("u4", 2)], "uuid string, cik bigint"),
        "information_table": frame(
            [("u4", "C"), ("u3", "B"), ("u3", "A"), ("u3", "A"), ("u1", "A")],
            "uuid string, cusip string",
        ),
    }
    store = FilingStore(holdings=tables)
    by_filer = store.get_form13_payload(cik=1)
    assert [tuple(r) for r in by_filer["information_table"].collect()] == [
        ("u3", "A"), ("u3", "A"), ("u3", "B"),
    ]
    by_security = store.get_form13_payload(cusip=["A", "C"])
    assert list(by_security) == list(tables)
    assert [tuple(r) for r in by_security["information_table"].collect()] == [
        ("u3", "A"), ("u3", "A"), ("u4", "C"),
    ]
    assert uuids(by_security["metadata"]) == uuids(by_security["header_data"]) == ["u3", "u4"]
    none = store.get_form13_payload(cusip="ZZZ")
    assert all(df.count() == 0 for df in none.values())
    with pytest.raises(ValueError):
        store.get_form13_payload(cik=1, cusip="A")


def test_footnotes_resolve_in_list_order(frame):
    rows = frame(
        [(1, "u", ["F2", "F1"]), (2, "u", []), (3, "u", None), (4, "u", ["F1", "F1", "F9"]), (5, "w", ["F1"])],
        "row bigint, uuid string, footnote_ids array<string>",
    )
    notes = frame(
        [("u", "F1", "one"), ("u", "F2", "two"), ("w", "F1", "other")],
        "uuid string, footnote_id string, footnote string",
    )
    got = {r["row"]: r["footnotes"] for r in payloads.resolve_footnotes(rows, notes, ["row"]).collect()}
    assert got == {1: ["two", "one"], 2: [], 3: None, 4: ["one", "one", None], 5: ["other"]}


def test_items_sort_and_filter(frame):
    items = frame(
        [("b", DAY, 2, "X"), ("a", DAY, 1, "Y"), ("c", DAY, 1, "X")],
        "form_uuid string, filing_date date, cik bigint, item_name string",
    )
    store = FilingStore(items=items)
    assert [r["form_uuid"] for r in store.get_form8_payload().collect()] == ["c", "a", "b"]
    assert [r["form_uuid"] for r in store.get_form8_payload(item="Y").collect()] == ["a"]
    assert store.get_form8_payload(cik=404).count() == 0
    dictionary = frame([("X", "ex")], "item string, description string")
    got = {(r["form_uuid"], r["description"]) for r in payloads.describe_items(items, dictionary).collect()}
    assert got == {("a", None), ("b", "ex"), ("c", "ex")}


BODY = (
    '{"calculation":{"calculationLinkbase":[["linkRole",{"definition":"d","role":"r"},{},'
    '["concept",{"label":"l","name":"n"},{"balance":"credit"}]]]}}'
)


def test_documents(frame):
    meta = json.dumps(
        {
            "cik": {"0": 320193},
            "filing_date": {"0": "2017-11-03T00:00:00-04:00"},
            "form_type": {"0": "10-K"},
            "is_real_time": {"0": True},
            "uuid": {"0": "d8"},
        }
    )
    raw = frame([(meta, BODY)], "meta string, body string").select(
        F.parse_json("meta").alias("meta"), F.parse_json("body").alias("data")
    )
    fields = {"cik": "bigint", "filing_date": "timestamp", "form_type": "string", "is_real_time": "boolean", "uuid": "string"}
    flat = payloads.flatten_meta(raw, fields)
    row = flat.first()
    assert (row["cik"], row["form_type"], row["is_real_time"], row["uuid"]) == (320193, "10-K", True, "d8")
    assert row["filing_date"].astimezone(dt.timezone.utc) == dt.datetime(2017, 11, 3, 4, tzinfo=dt.timezone.utc)
    label = payloads.document_path("data", "$.calculation.calculationLinkbase[0][3][1].label", "string")
    gone = payloads.document_path("data", "$.presentation", "string")
    assert tuple(flat.select(label, gone).first()) == ("l", None)
    nodes = payloads.document_nodes(flat.select("uuid", "data"), "data", "$.calculation.calculationLinkbase[0]")
    got = [(r["pos"], r["v"]) for r in nodes.select("pos", F.to_json("value").alias("v")).orderBy("pos").collect()]
    assert got[0] == (0, '"linkRole"') and got[2] == (2, "{}") and len(got) == 4

    documents = flat.withColumn("filing_date", F.lit("2017-11-03").cast("date"))
    store = FilingStore(documents=documents)
    assert store.get_form10_uuid_payload("d8").count() == 1
    assert store.get_form10_uuid_payload("d9").count() == 0
    assert store.get_form10_payload(cik=[320193, 5], start_datetime="2017-11-03T00:00:00+00:00", date_mode="publication_date").count() == 1
