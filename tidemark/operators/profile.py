"""Aggregate questions about a result: distinct values, corners, gaps, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def known(df: DataFrame, column: str) -> Column:
    """The column with NaN, which stands for a missing number, as NULL."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows (column_name, n_distinct); every value travels once per map task."""
    counted = column_values(df, *columns).where(F.col("value").isNotNull())
    return counted.groupBy("column_name").agg(F.count("*").alias("n_distinct"))


def corner_values(df: DataFrame, *columns: str) -> DataFrame:
    corners = [
        corner(c).alias(f"{prefix}_{c}")
        for c in columns
        for prefix, corner in (("min", F.min), ("max", F.max))
    ]
    return df.agg(*corners)


def missing_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows (column_name, n_missing, n_rows) from one pass; NaN is missing too."""
    aggs = [F.count_if(known(df, c).isNull()).alias(c) for c in columns]
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("n_missing"),
            F.col("_rows").alias("n_rows"),
        )
        for c in columns
    ]
    return df.agg(F.count("*").alias("_rows"), *aggs).select(F.inline(F.array(*pairs)))


def column_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows (column_name, value, n_rows): each column's distinct values as text, NaN as NULL.

    The whole list of values stays a distributed table, so a column may hold any
    number of them.
    """
    columns = columns or tuple(df.columns)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), known(df, c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(cells))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )


def column_profile(df: DataFrame, *columns: str) -> DataFrame:
    """Per column: distinct values, smallest and largest, missing, rows.

    The corners are those of the typed values, rendered as text afterwards; they and the missing
    count come from one pass, and only the distinct counts spread the cells out.
    """
    columns = columns or tuple(df.columns)
    aggs = [F.count("*").alias("_rows")]
    pairs = []
    for i, c in enumerate(columns):
        value = known(df, c)
        aggs += [
            F.min(value).cast("string").alias(f"_min{i}"),
            F.max(value).cast("string").alias(f"_max{i}"),
            F.count_if(value.isNull()).alias(f"_missing{i}"),
        ]
        pairs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_min{i}").alias("min_value"),
                F.col(f"_max{i}").alias("max_value"),
                F.col(f"_missing{i}").alias("n_missing"),
                F.col("_rows").alias("n_rows"),
            )
        )
    corners = df.agg(*aggs).select(F.inline(F.array(*pairs)))
    return corners.join(distinct_counts(df, *columns), "column_name", "left").select(
        "column_name",
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        "min_value",
        "max_value",
        "n_missing",
        "n_rows",
    )


def facet_profile(df: DataFrame, *columns: str) -> DataFrame:
    """Rows (column_name, value, n_distinct): every value of each column beside their number."""
    values = column_values(df, *columns).where(F.col("value").isNotNull())
    counts = values.groupBy("column_name").agg(F.count("*").alias("n_distinct"))
    return values.select("column_name", "value").join(counts, "column_name")


def rows_per_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))
