"""Filters by filer, security, form type and item, and filer look-up."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import guards, schemas
from tidemark.operators.asof import mapping_as_of
from tidemark.operators.joins import lookup, member_rows

# Longer lists travel as a table instead of a predicate.
IN_LIST_LIMIT = 500


def filter_ids(df: DataFrame, column: str, ids, unique: bool = False) -> DataFrame:
    """Rows whose `column` is in `ids`: a scalar, a list or a DataFrame of ids.

    None filters nothing, an empty list leaves nothing.
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).alias(column))
        return member_rows(df, keys, column, unique=unique)
    ids = guards.clean_ids(column, ids)
    kind = df.schema[column].dataType
    if len(ids) <= IN_LIST_LIMIT:
        return df.where(F.col(column).isin([F.lit(i).cast(kind) for i in ids]))
    # An Arrow table becomes a local relation of known size for the planner; the
    # range of the sorted list lets the scan skip row groups.
    keys = df.sparkSession.createDataFrame(pa.table({column: ids}))
    keys = keys.select(F.col(column).cast(kind).alias(column))
    ends = keys.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high = (F.lit(end).cast(kind) for end in ends)
    return member_rows(df.where(F.col(column).between(low, high)), keys, column)


def filter_filers(df: DataFrame, cik, column: str = "cik", unique: bool = False) -> DataFrame:
    if not isinstance(cik, DataFrame):
        cik = guards.clean_filers(cik)
    return filter_ids(df, column, cik, unique)


def filter_membership(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The same rows as `filter_ids`, by flagging members and keeping the flagged."""
    flagged = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
    flagged = flagged.withColumn("_member", F.lit(True))
    return lookup(df, flagged, column, stored=False).where("_member").drop("_member")


def filter_form_types(
    df: DataFrame, form_type=None, valid=None, column: str = "form_type"
) -> DataFrame:
    """Rows of the asked form types; a table stored by family is pruned to theirs."""
    forms = guards.check_form_types(form_type, valid)
    if forms is None:
        return df
    if valid is None and schemas.FAMILY in df.columns:
        asked = [f for f, types in schemas.FORM_FAMILIES.items() if set(types) & set(forms)]
        df = df.where(F.col(schemas.FAMILY).isin(asked))
    return df.where(F.col(column).isin(forms))


def filter_family(
    df: DataFrame, family: str, families=None, column: str = "form_type"
) -> DataFrame:
    """All form types of one family."""
    families = families or schemas.FORM_FAMILIES
    if family not in families:
        raise ValueError(f"unknown family {family}; known are {list(families)}")
    return df.where(F.col(column).isin(families[family]))


def filter_item(df: DataFrame, item: str | None = None, column: str = "item_name") -> DataFrame:
    return df if item is None else df.where(F.col(column) == item)


def filter_real_time(df: DataFrame, live: bool, column: str = "is_real_time") -> DataFrame:
    """Live rows, or the bulk-loaded history."""
    return df.where(F.col(column) if live else ~F.col(column))


def find_filers(
    id_map: DataFrame,
    filers: DataFrame,
    gvk=None,
    gvk_date: str | None = None,
    ticker: str | None = None,
    cusip: str | None = None,
    company: str | None = None,
) -> DataFrame:
    """Distinct padded filer ids by any combination of attributes.

    `filers` holds one row per filer attribute set, `cik` padded as in `id_map`.
    Each side is read only when one of its attributes is asked for.
    """
    for name, value in (("ticker", ticker), ("cusip", cusip), ("company", company)):
        if value is not None:
            filers = filers.where(F.col(name) == value)
    by_attribute = any(v is not None for v in (ticker, cusip, company))
    by_company_key = gvk is not None or gvk_date is not None
    if not by_company_key:
        return filers.select("cik").distinct()
    mapped = mapping_as_of(id_map, gvk=gvk, as_of_date=gvk_date).select("cik").distinct()
    return member_rows(mapped, filers, "cik", one_row_per_key=True) if by_attribute else mapped
