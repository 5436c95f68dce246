"""Half-open date windows over publication day or knowledge instant."""

from __future__ import annotations

import datetime as dt
import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import guards, schemas

FILING_ZONE = zoneinfo.ZoneInfo("America/New_York")


def day_literal(day: dt.date, dtype: T.DataType) -> Column:
    """Start of a filing day, in the type of the column it is compared with."""
    if isinstance(dtype, T.TimestampType):
        midnight = dt.datetime(day.year, day.month, day.day, tzinfo=FILING_ZONE)
        return F.lit(midnight.isoformat()).cast(dtype)
    return F.lit(day.isoformat()).cast(dtype)


def instant_literal(instant: dt.datetime, dtype: T.DataType) -> Column:
    """An instant, in the type of the column; zone-less columns hold UTC."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(instant.replace(tzinfo=None).isoformat()).cast(dtype)
    return F.lit(instant.isoformat()).cast(T.TimestampType())


def date_window(
    df: DataFrame,
    start_datetime: str | None = None,
    end_datetime: str | None = None,
    date_mode: str | None = None,
    publication: str = "filing_date",
    knowledge: str = "form_availability_timestamp",
) -> DataFrame:
    """Rows published, or known, in `[start, end)`.

    Publication bounds are cut to their UTC day, knowledge bounds are not. Only
    the bounds are transformed, so the predicate reaches the scan as it stands.
    A table stored by filing month is pruned to the months of the window.
    """
    low, high = guards.check_window(start_datetime, end_datetime, date_mode)
    column = publication if date_mode == "publication_date" else knowledge
    if date_mode == "publication_date" and schemas.FILING_MONTH in df.columns:
        month = F.col(schemas.FILING_MONTH)
        if low is not None:
            df = df.where(month >= low.strftime("%Y-%m"))
        if high is not None:
            df = df.where(month <= high.strftime("%Y-%m"))
    for bound, keep in ((low, Column.__ge__), (high, Column.__lt__)):
        if bound is not None:
            dtype = df.schema[column].dataType
            if date_mode == "publication_date":
                edge = day_literal(bound.date(), dtype)
            else:
                edge = instant_literal(bound, dtype)
            df = df.where(keep(F.col(column), edge))
    return df
