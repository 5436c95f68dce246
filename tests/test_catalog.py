import pytest

from tidemark.operators import catalog
from tidemark.store import ItemDictionary, SeriesCatalog

COLUMNS = "payload_id string, name string, commodity string, business_category string, country string, frequency string, unit string, start_date string"


@pytest.fixture
def rows(frame):
    goods = ["Coal", "Corn", None]
    return frame(
        [
            (f"p{i:03d}", f"{goods[i % 3]} Price {i}", goods[i % 3], "Trade", ["Brazil", "Belize"][i % 2], "Monthly", "t", "2000")
            for i in range(50)
        ],
        COLUMNS,
    )


def found(df):
    return sorted(r["payload_id"] for r in df.collect())


def test_search_joins_facets_with_and(rows):
    both = catalog.search(rows, text="price", commodity=["Coal"], country=["Brazil", "Chile"])
    assert found(both) == [f"p{i:03d}" for i in range(50) if i % 3 == 0 and i % 2 == 0]
    assert catalog.search(rows, text="", commodity=[], business_category="", country=None).count() == 50
    assert catalog.search(rows, text="no such text").count() == 0
    assert catalog.search(rows, commodity="Corn").count() == 17
    assert catalog.search_count(rows, commodity=["Coal"]).first()["total_count"] == 17


def test_facet_values(rows):
    values = catalog.facet_values(rows, "COMMODITIES")
    assert values.columns == ["COMMODITIES"]
    assert sorted(r[0] for r in values.collect()) == ["Coal", "Corn"]
    with pytest.raises(ValueError):
        catalog.facet_values(rows, "UNITS")


def test_pages_cover_the_result_once(rows):
    pages = [found(p) for p in catalog.pages(rows, ["payload_id"], size=20)]
    assert [len(p) for p in pages] == [20, 20, 10]
    assert sum(pages, []) == found(rows)
    two_columns = [found(p) for p in catalog.pages(rows, ["country", "payload_id"], size=13)]
    assert sorted(sum(two_columns, [])) == found(rows)
    assert len(list(catalog.pages(rows, ["payload_id"], size=20, pages_limit=2))) == 2
    assert list(catalog.pages(rows.limit(0), ["payload_id"])) == []
    assert found(catalog.numbered_page(rows, ["payload_id"], 2, 20)) == pages[1]
    assert found(catalog.offset_page(rows, ["payload_id"], 40, 20)) == pages[2]
    with pytest.raises(ValueError):
        catalog.numbered_page(rows, ["payload_id"], 0)


def test_series_catalog(rows, frame):
    series = frame(
        [("p001", "2020-12", "1", 1.0), ("p001", "2021-Q1", "2", 2.0), ("p002", "2021", "3", 3.0)],
        "payload_id string, original_period string, original_value string, value double",
    )
    client = SeriesCatalog(rows, series, page_size=20)
    with pytest.raises(ValueError):
        client.search_scroll()
    first = client.search(text="price")
    rest = list(client.search_pages(pages_limit=100))
    assert [len(found(p)) for p in [first, *rest]] == [20, 20, 10]
    client.search(text="price")
    assert len(list(client.search_pages(pages_limit=2))) == 1
    assert client.search(text="nothing").count() == 0
    points = client.get_payload("p001").orderBy("period").collect()
    assert [r["period"].isoformat() for r in points] == ["2020-12-31", "2021-03-31"]
    assert "FREQUENCIES" in client.list_of_metadata
    assert client.get_metadata_type("COUNTRIES").count() == 2
    assert client.search_count(country="Belize").first()[0] == 25


def test_item_dictionary(frame):
    items = ItemDictionary(frame([("A", "Net Income"), ("B", "Income Tax")], "item string, description string"))
    assert items.get_mapping().count() == 2
    assert [r["item"] for r in items.get_item_from_keywords("net income").collect()] == ["A", "B"]


def test_paging_goes_on_behind_null_keys(frame):
    rows = frame([(None, 1), (None, 2), (None, 3), ("a", 4), ("b", 5)], "name string, id int")
    found = [[r["id"] for r in page.collect()] for page in catalog.pages(rows, ["name", "id"], 2)]
    assert found == [[1, 2], [3, 4], [5]]
    assert len(list(catalog.pages(frame([(i,) for i in range(105)], "id int"), ["id"], 1))) == 105
