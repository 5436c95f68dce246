"""Pages by number: ranges of the key are counted, and a page is sought in the ranges that hold it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

PAGE_SIZE = 1000
RANGE_ROWS = 100_000


def with_position(df: DataFrame) -> DataFrame:
    """The rows of a sorted frame with their place in it, from 1.

    A sorted frame has its ranges in partition order, and so does the id that grows with it. The
    ranges are counted and summed up, one row a range; no task sees more than its range.
    """
    numbered = stored(df.withColumn("_id", F.monotonically_increasing_id()))
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = numbered.withColumns({"_part": part, "_place": place})
    counts = numbered.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    position = F.col("_start") + F.col("_place") + 1
    # one row a range
    return numbered.join(F.broadcast(starts), "_part").select(*df.columns, position.alias("position"))


def numbered_pages(df: DataFrame, key: list[str], size: int = PAGE_SIZE) -> DataFrame:
    """All rows with `position` in key order, from 1, and `page`, from 1: one sort by ranges, in
    which no task holds more than a range, however many pages there are."""
    placed = with_position(df.orderBy(*key))
    return placed.withColumn("page", F.floor((F.col("position") - 1) / size) + 1)


def key_ranges(df: DataFrame, key: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Ranges of the key in order, of about `range_rows` rows each: low, high (structs of the key), n,
    n_before; one row a range.

    Only the key columns are shuffled. The result is written, so that it serves any number of pages.
    """
    mark, ranges = F.struct(*key), max(1, math.ceil(df.count() / range_rows))
    ranged = df.select(*key).repartitionByRange(ranges, *key).withColumn("_range", F.spark_partition_id())
    found = ranged.groupBy("_range").agg(
        F.min(mark).alias("low"), F.max(mark).alias("high"), F.count("*").alias("n")
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before")
    return stored(found.select("low", "high", "n", before))


def _bound(df: DataFrame, key: list[str], mark) -> Column:
    return F.struct(*[F.lit(mark[k]).cast(df.schema[k].dataType).alias(k) for k in key])


def rows_between(
    df: DataFrame, key: list[str], offset: int, size: int, ranges: DataFrame | None = None
) -> DataFrame:
    """Rows `offset` to `offset + size` in key order, NULL first; the key is unique.

    The ranges that hold them are read off their counts; the rest of the table is filtered away, by
    the leading key column in the scan where it is not null. A task sorts rows of those ranges only,
    so a page at the end of a table costs what one at its beginning does.
    """
    ranges = key_ranges(df, key) if ranges is None else ranges
    held = ranges.where((F.col("n_before") < offset + size) & (F.col("n_before") + F.col("n") > offset))
    ends = held.agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("n_before").alias("before")
    ).first()
    if ends["low"] is None:
        return df.limit(0)
    low, high = ends["low"], ends["high"]
    mark, first = F.struct(*key), key[0]
    inside = (mark >= _bound(df, key, low)) & (mark <= _bound(df, key, high))
    kind = df.schema[first].dataType
    if low[first] is not None:  # null comes first, so nothing inside is null
        inside = inside & (F.col(first) >= F.lit(low[first]).cast(kind)) & (
            F.col(first) <= F.lit(high[first]).cast(kind)
        )
    found = df.where(inside).orderBy(*key)
    return found.offset(offset - ends["before"]).limit(size)


def page_by_number(
    df: DataFrame, key: list[str], number: int, size: int = PAGE_SIZE, ranges: DataFrame | None = None
) -> DataFrame:
    """Page `number`, counted from 1, of any depth; `ranges` of an earlier call may be given."""
    if number < 1:
        raise ValueError("pages are counted from 1")
    return rows_between(df, key, (number - 1) * size, size, ranges)
