"""The queries a user asks, bound to the tables of a lake."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import keywords as words
from tidemark.operators import asof, catalog, ids, payloads
from tidemark.sources.tables import exists, read_filings, read_table


class FilingStore:
    """Point-in-time filings. All results are lazy DataFrames of declared schema."""

    def __init__(
        self,
        headers: DataFrame | None = None,
        items: DataFrame | None = None,
        documents: DataFrame | None = None,
        insider: dict[str, DataFrame] | None = None,
        holdings: dict[str, DataFrame] | None = None,
        id_map: DataFrame | None = None,
        filers: DataFrame | None = None,
    ):
        self.headers = headers
        self.items = items
        self.documents = documents
        self.insider = insider
        self.holdings = holdings
        self.id_map = id_map
        self.filers = filers

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> FilingStore:
        """The tables stored below a folder, in their declared schemas; the absent ones are None."""

        def stored(name: str, schema: T.StructType) -> DataFrame | None:
            path = f"{folder}/{name}"
            return read_filings(spark, path, schema) if exists(spark, path) else None

        def several(group: str, declared: dict[str, T.StructType]) -> dict[str, DataFrame] | None:
            found = {name: stored(f"{group}/{name}", schema) for name, schema in declared.items()}
            return None if any(df is None for df in found.values()) else found

        mapped = exists(spark, f"{folder}/id_map.parquet")
        return cls(
            headers=stored("headers", schemas.HEADERS),
            items=stored("items", schemas.FORM8_ITEMS),
            documents=stored("documents", schemas.DOCUMENTS),
            insider=several("insider", schemas.INSIDER),
            holdings=several("holdings", schemas.HOLDINGS),
            id_map=read_table(spark, folder, "id_map", schemas.ID_MAP) if mapped else None,
        )

    @property
    def form_types(self) -> list[str]:
        return list(schemas.FORM_TYPES)

    def get_form_headers(
        self,
        form_type=None,
        cik=None,
        start_datetime=None,
        end_datetime=None,
        date_mode=None,
        ordered: bool = True,
    ) -> DataFrame:
        return payloads.form_headers(
            self.headers,
            ordered=ordered,
            form_type=form_type,
            cik=cik,
            start_datetime=start_datetime,
            end_datetime=end_datetime,
            date_mode=date_mode,
        )

    def get_form4_payload(
        self,
        cik=None,
        start_datetime=None,
        end_datetime=None,
        date_mode=None,
        keep_parent: bool = False,
    ) -> dict[str, DataFrame]:
        return payloads.insider_payload(
            self.insider,
            keep_parent=keep_parent,
            cik=cik,
            start_datetime=start_datetime,
            end_datetime=end_datetime,
            date_mode=date_mode,
        )

    def get_form8_payload(
        self,
        cik=None,
        start_datetime=None,
        end_datetime=None,
        date_mode=None,
        item=None,
        ordered: bool = True,
    ) -> DataFrame:
        return payloads.item_payload(
            self.items, cik, start_datetime, end_datetime, date_mode, item, ordered
        )

    def get_form10_payload(
        self, cik=None, start_datetime=None, end_datetime=None, date_mode=None
    ) -> DataFrame:
        return payloads.document_payload(
            self.documents,
            cik=cik,
            start_datetime=start_datetime,
            end_datetime=end_datetime,
            date_mode=date_mode,
        )

    def get_form10_uuid_payload(self, uuid) -> DataFrame:
        return payloads.document_by_uuid(self.documents, uuid)

    def get_form13_payload(
        self,
        cik=None,
        cusip=None,
        start_datetime=None,
        end_datetime=None,
        date_mode=None,
        ordered: bool = True,
        keep_parent: bool = False,
    ) -> dict[str, DataFrame]:
        held = payloads.holdings_payload(
            self.holdings,
            keep_parent=keep_parent,
            cik=cik,
            cusip=cusip,
            start_datetime=start_datetime,
            end_datetime=end_datetime,
            date_mode=date_mode,
        )
        lines = held["information_table"]
        return {
            **held,
            "information_table": payloads.ordered_holdings(lines) if ordered else lines,
        }

    def get_cik(
        self, gvk=None, gvk_date=None, ticker=None, cusip=None, company=None
    ) -> DataFrame:
        return ids.find_filers(self.id_map, self.filers, gvk, gvk_date, ticker, cusip, company)


class KeyMapper:
    """Filer key to company key and back."""

    def __init__(self, id_map: DataFrame):
        self.id_map = id_map

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> KeyMapper:
        return cls(read_table(spark, folder, "id_map", schemas.ID_MAP))

    def get_gvk_from_cik(self, cik, as_of_date: str | None = None) -> DataFrame:
        return asof.gvk_from_cik(self.id_map, cik, as_of_date)

    def get_cik_from_gvk(self, gvk, as_of_date: str | None = None) -> DataFrame:
        return asof.cik_from_gvk(self.id_map, gvk, as_of_date)


class ItemDictionary:
    """Item codes and their descriptions."""

    def __init__(self, items: DataFrame):
        self.items = items

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> ItemDictionary:
        return cls(read_table(spark, folder, "items", schemas.ITEMS))

    def get_mapping(self) -> DataFrame:
        return self.items

    def get_item_from_keywords(self, keywords) -> DataFrame:
        return words.search_items(self.items, keywords).select(*self.items.columns)


class SeriesCatalog:
    """Search for series, page through the result, fetch their points."""

    KEY = ["payload_id"]

    def __init__(self, rows: DataFrame, series: DataFrame, page_size: int = catalog.PAGE_SIZE):
        self.rows = rows
        self.series = series
        self.page_size = page_size
        self._pages: Iterator[DataFrame] | None = None

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> SeriesCatalog:
        return cls(
            read_table(spark, folder, "catalog", schemas.CATALOG),
            read_table(spark, folder, "series", schemas.SERIES_VALUES),
        )

    @property
    def list_of_metadata(self) -> list[str]:
        return catalog.list_of_metadata()

    def get_metadata_type(self, metadata_type: str) -> DataFrame:
        return catalog.facet_values(self.rows, metadata_type)

    def search_count(self, **query) -> DataFrame:
        return catalog.search_count(self.rows, **query)

    def search(self, **query) -> DataFrame:
        """First page; `search_scroll` and `search_pages` go on from it."""
        found = catalog.search(self.rows, **query)
        self._pages = catalog.pages(found, self.KEY, self.page_size, pages_limit=None)
        first = next(self._pages, None)
        return found.limit(0) if first is None else first

    def search_all(self, **query) -> DataFrame:
        """All rows of a search as one frame, to go on with in Spark."""
        return catalog.search(self.rows, **query)

    def search_scroll(self) -> DataFrame | None:
        """The next page, None behind the last one."""
        if self._pages is None:
            raise ValueError("call search first")
        return next(self._pages, None)

    def search_pages(self, pages_limit: int = 100) -> Iterator[DataFrame]:
        """Pages behind the first, so that at most `pages_limit` are seen in all."""
        for _ in range(pages_limit - 1):
            page = self.search_scroll()
            if page is None:
                return
            yield page

    def get_payload(self, payload_id: str) -> DataFrame:
        return catalog.series_payload(self.series, payload_id)
