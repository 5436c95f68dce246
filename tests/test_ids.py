import random

import pytest

from tidemark import schemas
from tidemark.operators import ids


@pytest.fixture
def rows(spark):
    return spark.range(3000).selectExpr("id AS uuid", "id % 1000 AS cik")


def test_long_lists_short_lists_and_tables_agree(spark, rows):
    wanted = random.Random(1).sample(range(1, 1000), 700)
    table = spark.createDataFrame([(i,) for i in wanted + wanted[:50]], "anything bigint")
    expected = sorted(r["uuid"] for r in rows.collect() if r["cik"] in set(wanted))
    with pytest.warns(UserWarning):
        by_list = ids.filter_filers(rows, wanted + wanted[:50])
    for found in (by_list, ids.filter_filers(rows, table), ids.filter_membership(rows, "cik", table)):
        assert sorted(r["uuid"] for r in found.collect()) == expected
    few = wanted[:3]
    assert ids.filter_filers(rows, few).count() == 9
    assert ids.filter_filers(rows, None).count() == 3000
    assert ids.filter_filers(rows, []).count() == 0
    assert ids.filter_filers(rows, few[0]).count() == 3


def test_families_and_live_rows(frame):
    rows = frame([("3", True), ("8-K", False), ("10-Q", True)], "form_type string, is_real_time boolean")
    assert ids.filter_family(rows, "form8").count() == 1
    assert ids.filter_real_time(rows, True).count() == 2
    assert ids.filter_real_time(rows, False).count() == 1
    with pytest.raises(ValueError):
        ids.filter_family(rows, "form99")
    assert len(schemas.FORM_TYPES) == 14


@pytest.mark.parametrize("limit", [0, 100])
def test_ids_of_another_type_are_cast(frame, monkeypatch, limit):
    monkeypatch.setattr(ids, "IN_LIST_LIMIT", limit)
    rows = frame([("7",), ("8",), ("07",), (None,)], "uuid string")
    assert [r[0] for r in ids.filter_ids(rows, "uuid", [7, 9]).collect()] == ["7"]
    numbers = frame([(7,), (8,)], "uuid bigint")
    assert [r[0] for r in ids.filter_ids(numbers, "uuid", ["7", "30"]).collect()] == [7]


def test_find_filers(frame):
    id_map = frame(
        [("0000000001", "2000-01-01", "2005-12-31", "000010"), ("0000000002", "2006-01-01", "2100-12-31", "000010")],
        "cik string, effdate string, thrudate string, gvk string",
    ).selectExpr("cik", "cast(effdate AS timestamp_ntz) effdate", "cast(thrudate AS timestamp_ntz) thrudate", "gvk")
    filers = frame(
        [("0000000001", "AA", "c1", "One"), ("0000000002", "BB", "c2", "Two")],
        "cik string, ticker string, cusip string, company string",
    )

    def found(**asked):
        return sorted(r["cik"][-1] for r in ids.find_filers(id_map, filers, **asked).collect())

    assert found(gvk=10) == ["1", "2"]
    assert found(gvk=10, gvk_date="2006-01-01") == ["2"]
    assert found(ticker="AA") == ["1"]
    assert found(ticker="AA", company="Two") == []
    assert found(gvk=10, cusip="c2") == ["2"]
