"""Faceted catalog search, facet values, paging, and series by id."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import guards, schemas
from tidemark.functions.periods import with_period
from tidemark.operators import paging

PAGE_SIZE = paging.PAGE_SIZE
TEXT_COLUMNS = ["name", "commodity", "business_category", "country", "frequency", "unit"]


def search(
    catalog: DataFrame,
    text: str = "",
    commodity=None,
    business_category=None,
    country=None,
    frequency=None,
) -> DataFrame:
    """Catalog rows meeting every given facet; an empty string or list filters nothing."""
    facets = {
        "commodity": commodity,
        "business_category": business_category,
        "country": country,
        "frequency": frequency,
    }
    for column, value in facets.items():
        if value:
            catalog = catalog.where(F.col(column).isin(guards.clean_ids(column, value)))
    if text:
        present = [F.col(c) for c in TEXT_COLUMNS if c in catalog.columns]
        haystack = F.lower(F.concat_ws(" ", *present))
        catalog = catalog.where(F.contains(haystack, F.lower(F.lit(text))))
    return catalog


def search_count(catalog: DataFrame, **query) -> DataFrame:
    return search(catalog, **query).agg(F.count("*").alias("total_count"))


def facet_values(catalog: DataFrame, facet: str) -> DataFrame:
    """Distinct values of a facet, in one column titled by it."""
    column = guards.check_facet(facet)
    values = catalog.select(F.col(column).alias(facet)).distinct()
    return values.where(F.col(facet).isNotNull())


def after(df: DataFrame, key: list[str], last: tuple) -> DataFrame:
    """Rows behind `last` in key order, NULL first as in the sort; the leading bound
    reaches the scan, where there is one."""
    mark = [F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(key, last)]
    behind = F.struct(*key) > F.struct(*mark)
    return df.where(behind if last[0] is None else (F.col(key[0]) >= mark[0]) & behind)


def page_after(
    df: DataFrame, key: list[str], last: tuple | None = None, size: int = PAGE_SIZE
) -> DataFrame:
    """The page behind `last` (the first page without it) by a unique key."""
    rest = df if last is None else after(df, key, last)
    return rest.orderBy(*key).limit(size)


def offset_page(df: DataFrame, key: list[str], offset: int, size: int = PAGE_SIZE) -> DataFrame:
    """Rows from `offset` on in key order, sought in the key ranges that hold them."""
    return paging.rows_between(df, key, offset, size)


def numbered_page(df: DataFrame, key: list[str], number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page `number`, counted from 1, at any depth."""
    return paging.page_by_number(df, key, number, size)


def pages(
    df: DataFrame, key: list[str], size: int = PAGE_SIZE, pages_limit: int | None = None
) -> Iterator[DataFrame]:
    """Pages in key order, each started from the last key of the one before.

    For interactive use, page by page; `paging.numbered_pages` numbers all pages in one job.
    A page is kept until the next one is asked for, so its last key, all that comes to the
    driver, and its rows are of one computation.
    """
    last = None
    for _ in itertools.count() if pages_limit is None else range(pages_limit):
        page = page_after(df, key, last, size).persist()
        try:
            found = page.agg(F.max(F.struct(*key)).alias("last")).first()["last"]
            if found is None:
                return
            yield page
        finally:
            page.unpersist()
        last = tuple(found)


def series_payload(series: DataFrame, payload_id=None) -> DataFrame:
    """Points of one series, or of all, with the normalised period."""
    if payload_id is not None:
        series = series.where(F.col("payload_id") == payload_id)
    return with_period(series)


def list_of_metadata() -> list[str]:
    return list(schemas.FACETS)
