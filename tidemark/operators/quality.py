"""Data-quality expectations as queries that return the violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import KEY_HASH, member_rows, with_key_hash
from tidemark.operators.profile import missing_counts, rows_per_key


def duplicated_values(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows_per_key(df, *keys).where("n_rows > 1")


def duplicate_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Every row whose key occurs more than once.

    Keys are counted with map-side combine and joined back; a window per key
    would put all copies of one key into one task. NULL equals NULL, as in the count:
    the hash of the key is the equi key, which spreads the rows, and decides nothing.
    """
    found = with_key_hash(duplicated_values(df, *keys).drop("n_rows"), keys)
    rows = with_key_hash(df, keys)
    same = [rows[k].eqNullSafe(found[k]) for k in keys]
    return rows.join(found, [rows[KEY_HASH] == found[KEY_HASH], *same], "left_semi").drop(KEY_HASH)


def unexpected_missing(
    df: DataFrame, expected: dict[str, int] | None = None, *columns: str
) -> DataFrame:
    """Missing counts with the allowed number and whether it is met."""
    expected = expected or {}
    names = columns or tuple(expected)
    allowed = F.lit(0)
    for name, n in expected.items():
        allowed = F.when(F.col("column_name") == name, n).otherwise(allowed)
    return (
        missing_counts(df, *names)
        .withColumn("n_allowed", allowed.cast("bigint"))
        .withColumn("met", F.col("n_missing") <= F.col("n_allowed"))
    )


def range_conformance(df: DataFrame, column: str, low, high) -> DataFrame:
    """Does every value lie in `[low, high)`; bounds are literal columns."""
    inside = (F.col(column) >= low) & (F.col(column) < high)
    return df.agg(
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.count_if(~inside).alias("n_outside"),
        F.coalesce(F.bool_and(inside), F.lit(True)).alias("conforms"),
    )


def monotonic_violations(
    df: DataFrame, series: list[str], position: list[str], value: str
) -> DataFrame:
    """Per series: rows, falls and repeats of `value` when read in position order.

    Rows are range-partitioned by (series, position), so a long series spans
    many tasks; neighbours are compared inside a range, and the ranges are joined
    up over one summary row per (range, series). Positions are unique per series. A row
    without a value is counted and passed over: its neighbours are compared with each other.
    """
    ranged = (
        df.select(*series, *position, F.col(value).alias("_value"))
        .repartitionByRange(*series, *position)
        .withColumn("_range", F.spark_partition_id())
    )
    inside = Window.partitionBy("_range", *series).orderBy(*position)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last("_value", ignorenulls=True).over(earlier)
    at = F.when(F.col("_value").isNotNull(), F.struct(*position))
    ranges = (
        ranged.withColumn("_before", previous)
        .groupBy("_range", *series)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("_value") < F.col("_before")).alias("falls"),
            F.count_if(F.col("_value") == F.col("_before")).alias("repeats"),
            F.min_by("_value", at).alias("_head"),
            F.max_by("_value", at).alias("_tail"),
        )
    )
    across = Window.partitionBy(*series).orderBy("_range")
    across = across.rowsBetween(Window.unboundedPreceding, -1)
    seam = ranges.withColumn("_before", F.last("_tail", ignorenulls=True).over(across))
    falls = F.sum("falls") + F.count_if(F.col("_head") < F.col("_before"))
    repeats = F.sum("repeats") + F.count_if(F.col("_head") == F.col("_before"))
    return seam.groupBy(*series).agg(
        F.sum("n").alias("n_rows"), falls.alias("n_falls"), repeats.alias("n_repeats")
    )


def type_agreement(left: DataFrame, right: DataFrame, left_column: str, right_column: str) -> bool:
    """Do two typed columns share one type."""
    return left.schema[left_column].dataType == right.schema[right_column].dataType


def variant_types(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Types a variant column holds, of all rows or per group, with their row counts; one row
    means one type."""
    kind = F.schema_of_variant(F.col(column)).alias("value_type")
    return df.groupBy(*by, kind).agg(F.count("*").alias("n_rows"))


def not_allowed_values(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Values outside the allowed set with their counts; values are counted first,
    so the anti join meets one row per value."""
    counted = rows_per_key(df, column).where(F.col(column).isNotNull())
    keys = allowed.select(F.col(allowed.columns[0]).alias(column))
    return member_rows(counted, keys, column, one_row_per_key=True, negate=True)
