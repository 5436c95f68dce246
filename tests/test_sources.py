import datetime as dt
import gzip
import json

import pytest
from pyspark.errors import PySparkException

from tidemark import schemas
from tidemark.operators.payloads import children_of, document_by_uuid, form_headers
from tidemark.sources import files, pages, tables
from tidemark.store import FilingStore, ItemDictionary, KeyMapper, SeriesCatalog

ROW = schemas.struct(uuid=schemas.STRING, cik=schemas.LONG)
URL = "http://host.example/headers?form_type=3"


def page(offset, rows, following, count=5, query=URL):
    links = {"self": query + (f"&offset={offset}" if offset else ""), "first": query, "last": f"{query}&offset=4"}
    if following:
        links["next"] = f"{query}&offset={following}"
    return {"links": links, "count": count, "data": rows}


def rows_of(*numbers):
    return [{"uuid": f"u{n}", "cik": n} for n in numbers]


@pytest.fixture
def landed(tmp_path):
    for i, body in enumerate([page(0, rows_of(1, 2), 2), page(2, rows_of(3, 4), 4), page(4, rows_of(5), None)]):
        (tmp_path / f"{i}.json").write_text(json.dumps(body, indent=1))
    return tmp_path


def test_pages_union_and_complete(spark, landed):
    read = pages.read_pages(spark, str(landed), ROW, multi_line=True)
    assert sorted(r["cik"] for r in pages.page_rows(read).collect()) == [1, 2, 3, 4, 5]
    assert sorted(r[0] for r in read.select(pages.page_offset()).collect()) == [0, 2, 4]
    row = pages.page_completeness(read).first()
    assert tuple(row) == (URL, 3, 5, 5, 1, True)


def test_lost_page_is_noticed(spark, landed):
    (landed / "2.json").unlink()
    row = pages.page_completeness(pages.read_pages(spark, str(landed), ROW, multi_line=True)).first()
    assert (row["n_rows"], row["n_last_pages"], row["complete"]) == (4, 0, False)


def test_request_is_the_link_without_its_offset(frame):
    links = {
        "x?offset=500&form=3": "x?form=3", "x?form=3": "x?form=3", "x?form=3&offset=1": "x?form=3",
        "x?a=1&offset=2&b=3": "x?a=1&b=3", "x?offset=7": "x", "x": "x", "x?page_offset=1": "x?page_offset=1",
    }
    df = frame([(k,) for k in links], "self string")
    assert {r[0]: r[1] for r in df.select("self", pages.page_request("self")).collect()} == links


def test_unreadable_page_stops_strict_readers(spark, landed):
    (landed / "3.json").write_text('{"message": "no such form"}')
    with pytest.raises(PySparkException):
        pages.read_pages(spark, str(landed), ROW, multi_line=True).collect()
    with pytest.raises(ValueError):
        pages.read_tables(spark, str(landed / "3.json"), {"metadata": ROW})


def test_error_bodies_are_rejected(spark, landed):
    (landed / "3.json").write_text('{"message": "no such form"}')
    (landed / "4.json").write_text('{"links": {"self": "x"}, "data": [{"uu')
    good, rejects = pages.split_pages(spark, str(landed), ROW, multi_line=True)
    assert pages.page_rows(good).count() == 5
    assert pages.page_completeness(good).first()["complete"]
    assert sorted(r["value"][:8] for r in rejects.collect()) == ['{"links"', '{"messag']


def test_tables_merge_over_pages(spark, tmp_path):
    bodies = [
        page(0, {"metadata": rows_of(1), "lines": [{"uuid": "u1", "v": 1}]}, 1),
        page(1, {"metadata": rows_of(2)}, None),
    ]
    path = tmp_path / "p.json"
    path.write_text("\n".join(json.dumps(b) for b in bodies))
    lines = schemas.struct(uuid=schemas.STRING, v=schemas.LONG)
    read = pages.read_tables(spark, str(path), {"metadata": ROW, "lines": lines})
    assert read["metadata"].count() == 2 and read["lines"].count() == 1
    merged = pages.merge_tables([read, {"extra": read["lines"], "lines": read["lines"].drop("v")}])
    assert list(merged) == ["metadata", "lines", "extra"]
    assert sorted((r["v"] for r in merged["lines"].collect()), key=str) == [1, None]


def test_bodies_that_do_not_parse_are_rejected(frame):
    texts = [('{"uuid":"a","cik":1}',), ('{"message": ',), ("[]oops",), ('{"uuid":"b","cik":"x"}',)]
    rows, rejects = pages.parse_rows(frame(texts, "value string"), ROW)
    assert [tuple(r) for r in rows.collect()] == [("a", 1)]
    assert rejects.count() == 3


def test_json_keeps_microseconds(spark, frame, tmp_path):
    schema = schemas.struct(at=schemas.ZONELESS, known=schemas.INSTANT)
    at = dt.datetime(2020, 1, 1, 1, 2, 3, 456789)
    df = frame([(at, at)], "at timestamp_ntz, known timestamp")
    files.write_json(df, str(tmp_path / "j"))
    assert files.read_json(spark, str(tmp_path / "j"), schema).collect() == df.collect()


def test_text_round_trip_gzip_and_append(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    files.write_text(frame([("a",), ("",)], "value string"), path, gzip=True)
    files.write_text(frame([("b\r",)], "value string"), path, gzip=True, append=True)
    assert sorted(r[0] for r in files.read_text(spark, path).collect()) == ["", "a", "b\r"]
    files.write_text(frame([("c",)], "value string"), path)
    assert [r[0] for r in files.read_text(spark, path).collect()] == ["c"]


def test_undecodable_text_raises(spark, tmp_path):
    (tmp_path / "bad.gz").write_bytes(gzip.compress(b"fine\n\xff\xfe\n"))
    with pytest.raises(PySparkException):
        files.read_text(spark, str(tmp_path / "bad.gz")).collect()
    assert files.read_text(spark, str(tmp_path / "bad.gz"), strict=False).count() == 2


def test_ragged_columns_line_up(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a":[1,2,3],"b":[9]}\n{"b":[7]}\n')
    schema = schemas.struct(a=schemas.LONGS, b=schemas.LONGS)
    got = {tuple(r) for r in files.read_ragged_columns(spark, str(tmp_path), schema).collect()}
    assert got == {(1, 9), (2, None), (3, None), (None, 7)}
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "r.json").write_text('{\n "a": [1, 2],\n "b": [9]\n}')
    one = files.read_ragged_columns(spark, str(tmp_path / "one"), schema, multi_line=True)
    assert {tuple(r) for r in one.collect()} == {(1, 9), (2, None)}


def test_universe_and_file_selection(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("12\n 7 \n")
    assert [r["cik"] for r in files.read_universe(spark, str(tmp_path / "ids.txt")).collect()] == [12, 7]
    for place in ("x", "x/y", "z"):
        (tmp_path / "tree" / place).mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / place / "a.json").write_text('{"cik": 1}')
        (tmp_path / "tree" / place / "a.txt").write_text("no json")
    root, schema = str(tmp_path / "tree"), schemas.struct(cik=schemas.LONG)
    assert files.select_files(spark, root, "*.json", schema).count() == 3
    assert files.select_files(spark, root, "*.json", schema, regex="/x/").count() == 2


def test_stored_filings_are_pruned_by_family_and_month(spark, frame, tmp_path):
    columns = "uuid string, cik bigint, form_type string, filing_date date"
    rows = [
        (f"{family}-{month}", month, form, dt.date(2020, month, 2))
        for family, form in (("form4", "4"), ("form13", "13F-HR"))
        for month in range(1, 7)
    ]
    path = str(tmp_path / "lake")
    for family, form in (("form4", "4"), ("form13", "13F-HR")):
        tables.write_filings(frame([r for r in rows if r[2] == form], columns), path, family)
    stored = tables.read_filings(spark, path, frame([], columns).schema)
    assert stored.count() == 12
    found = form_headers(
        stored,
        form_type="4",
        start_datetime="2020-02-02T00:00:00+00:00",
        end_datetime="2020-04-02T00:00:00+00:00",
        date_mode="publication_date",
    )
    assert [r["uuid"] for r in found.collect()] == ["form4-2", "form4-3"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "family" in pruned and "filing_month" in pruned
    lines = frame([(r[0], r[3], n) for r in rows for n in range(3)], "uuid string, filing_date date, n int")
    tables.write_filings(lines, str(tmp_path / "lines"), "form4")
    child = tables.read_filings(spark, str(tmp_path / "lines"), lines.schema)
    held = children_of(found, child)
    assert sorted(r["uuid"] for r in held.collect()) == ["form4-2"] * 3 + ["form4-3"] * 3
    scans = held._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]
    assert all("filing_month" in scan.split("PushedFilters")[0] for scan in scans)


def test_month_is_that_of_the_filing_zone(spark, frame, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            rows = spark.sql(
                "SELECT 'a' AS uuid, 1L AS cik, '4' AS form_type, timestamp'2021-03-01T05:30:00Z' AS filing_date"
                " UNION ALL SELECT 'b', 1L, '4', timestamp'2021-03-01T04:30:00Z'"
            )
            path = str(tmp_path / name.replace("/", "-"))
            tables.write_filings(rows, path, "form4")
            stored = tables.read_filings(spark, path, rows.schema)
            assert {r["uuid"]: r["filing_month"] for r in stored.collect()} == {"a": "2021-03", "b": "2021-02"}
            window = dict(start_datetime="2021-03-01T00:00:00+00:00", date_mode="publication_date")
            for source in (rows, stored):
                assert [r["uuid"] for r in form_headers(source, **window).collect()] == ["a"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_uuid_look_up_skips_row_groups(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "uuid(7) AS uuid", "id AS cik", "date'2021-03-05' AS filing_date", "id % 97 AS n"
    )
    path = str(tmp_path / "lake")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 << 10))
    try:
        tables.write_filings(rows, path, "form10")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    stored = tables.read_filings(spark, path, rows.schema)
    wanted = stored.first()["uuid"]
    found = document_by_uuid(stored, wanted)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan()
    assert "EqualTo(uuid" in plan.toString() or "In(uuid" in plan.toString()
    # count what the scan hands on: only the row groups that may hold the uuid
    node = found.select("uuid", "n")
    node.collect()
    executed = node._jdf.queryExecution().executedPlan()
    leaves = executed.collectLeaves()
    read = leaves.apply(0).metrics().get("numOutputRows").get().value()
    assert 1 <= read < 20_000


def test_window_prunes_the_lines_of_a_security(spark):
    from tidemark.plans import lake

    store = FilingStore.open(spark, lake.holdings_lake(spark, "/root/testdata/sf0.001"))
    assert store.headers is None and store.insider is None
    lines = store.get_form13_payload(cusip=["3"], ordered=False, **lake.WINDOW)
    plan = lines["information_table"]._jdf.queryExecution().executedPlan().toString()
    scans = [s.split("PushedFilters")[0] for s in plan.split("PartitionFilters: ")[1:]]
    assert len(scans) >= 2 and all("filing_month" in s for s in scans)


def test_child_rows_get_the_day_of_their_filing(frame):
    parent = frame([("u1", dt.date(2020, 1, 2)), ("u2", dt.date(2020, 2, 3))], "uuid string, filing_date date")
    child = frame([("u1", 1), ("u1", 2), ("u3", 3)], "uuid string, n int")
    got = sorted(tuple(r) for r in tables.with_filing_day(child, parent).collect())
    assert got == [("u1", 1, dt.date(2020, 1, 2)), ("u1", 2, dt.date(2020, 1, 2))]


def test_stored_lookup_tables_open_in_their_schemas(spark, frame, tmp_path):
    folder = str(tmp_path)
    samples = {
        "id_map": ([("1", dt.datetime(2000, 1, 1), dt.datetime(2100, 12, 31), "7")], schemas.ID_MAP),
        "items": ([("AT", "Total assets")], schemas.ITEMS),
        "catalog": ([("gdp", "c", "p1", "b", "x", "M", "usd", "1999")], schemas.CATALOG),
        "series": ([("p1", "1999-01", "2.5", 2.5)], schemas.SERIES_VALUES),
    }
    for name, (rows, schema) in samples.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    assert KeyMapper.open(spark, folder).id_map.count() == 1
    assert ItemDictionary.open(spark, folder).get_mapping().first()["item"] == "AT"
    found = SeriesCatalog.open(spark, folder)
    assert found.search_count(text="GDP").first()[0] == 1
    assert found.get_payload("p1").first()["period"] == dt.date(1999, 1, 31)
    store = FilingStore.open(spark, folder)
    assert store.id_map.schema == schemas.ID_MAP and store.headers is None


def test_a_body_with_more_behind_it_is_rejected(spark, tmp_path):
    first = '{"data": []}'
    texts = [first, first + "\n", f"{first}\nBad Gateway\n{first}", f"{first} {first}", first + "}"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    good, rejects = pages.split_pages(spark, str(tmp_path), ROW, multi_line=True)
    assert good.count() == 2 and sorted(r["value"] for r in rejects.collect()) == sorted(texts[2:])
    with pytest.raises(Exception, match="unreadable page"):
        pages.read_pages(spark, str(tmp_path), ROW, multi_line=True).collect()
