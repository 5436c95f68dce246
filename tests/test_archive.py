"""Stored documents, insider forms and catalogs: what conforming reads, and what their scans skip."""

import json

import pytest

from tidemark import schemas
from tidemark.functions import conform
from tidemark.plans import archive
from tidemark.sources.tables import write_catalog
from tidemark.store import FilingStore, SeriesCatalog


@pytest.mark.parametrize(
    "text, found",
    [
        ("F1, F2", ["F1", "F2"]),
        ("['F1', 'F2']", ["F1", "F2"]),
        ('["F1"]', ["F1"]),
        ("(F1,)", ["F1"]),
        ("it's, (a)", ["it's", "(a"]),
        ("[]", None),
        ("  ", None),
        ("NA", None),
        (None, None),
    ],
)
def test_lists_of_texts(frame, text, found):
    rows = frame([("u", text)], "uuid string, footnote_ids string")
    assert conform.conform(rows, schemas.INSIDER_CHILD).first()["footnote_ids"] == found


def test_bodies_as_texts(frame):
    bodies = ['{"k": 1}', '{"k": ', "NA", " ", None, "[1, 2]", "5"]
    rows = frame([(str(i), b) for i, b in enumerate(bodies)], "uuid string, data string")
    read = conform.conform(rows, schemas.DOCUMENTS).selectExpr("to_json(data) AS text").collect()
    want = [{"k": 1}, None, None, None, None, [1, 2], 5]
    assert [r.text and json.loads(r.text) for r in read] == want
    lost = conform.conform_failures(rows, schemas.DOCUMENTS).where("n_failed > 0").collect()
    assert [(r.column_name, r.n_failed) for r in lost] == [("data", 1)]


def test_a_window_prunes_stored_documents_and_insider_tables(spark):
    folder = "/root/testdata/sf0.001"
    window = dict(
        start_datetime="2024-01-10T00:00:00+00:00",
        end_datetime="2024-01-12T00:00:00+00:00",
        date_mode="publication_date",
    )
    store = FilingStore.open(spark, archive.documents_lake(spark, folder))
    plan = store.get_form10_payload(**window)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "filing_month" in plan.split("PartitionFilters")[1][:400]
    store = FilingStore.open(spark, archive.insider_lake(spark, folder))
    assert set(store.insider) == set(schemas.INSIDER_TABLES)
    assert store.insider["reporting_owner_info"].count() == 0


def test_stored_catalog_has_both_vintages_and_no_rows_of_an_empty_one(spark, frame, tmp_path):
    old = frame([("a", " x ", "NA")], "payload_id string, name string, commodity string")
    live = frame([], "payload_id string, name string, commodity string, unit string")
    points = frame([("a", "2020-M01", "NA", "NA"), ("a", "2020-M02", "1.5", "1.5")],
                   "payload_id string, original_period string, original_value string, value string")
    lost = write_catalog([old, live], [points], str(tmp_path))
    assert lost.count() == 0
    store = SeriesCatalog.open(spark, str(tmp_path))
    row = store.rows.first()
    assert (row["name"], row["commodity"], row["unit"]) == ("x", None, None)
    found = store.get_payload("a").orderBy("original_period").collect()
    assert [r["value"] for r in found] == [None, 1.5]
    assert store.search_all(text="X").count() == 1
