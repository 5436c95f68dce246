"""Profiles kept by part of a table (a month, a load) and merged, without reading the rows again.

Exact profiles are in `profile`; here the number of distinct values is an estimate from a sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.profile import known

LOG_SIZE = 12  # 4096 registers: few values are counted exactly, many within some 2 percent


def part_profiles(df: DataFrame, part: Column, *columns: str, log_size: int = LOG_SIZE) -> DataFrame:
    """(part, n_rows, columns): one row a part, and in `columns` a struct (low, high, n_missing,
    sketch) for each column, all that merges.

    Corners keep the column's type. NaN is missing; NULL is a part like any other. The names of the
    columns are free, as they stand within `columns`. An empty table has no parts.
    """
    columns = columns or tuple(df.columns)

    def summary(name: str) -> Column:
        value = known(df, name)
        return F.struct(
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.count_if(value.isNull()).alias("n_missing"),
            F.hll_sketch_agg(value.cast("string"), F.lit(log_size)).alias("sketch"),
        ).alias(name)

    cells = F.struct(*[summary(c) for c in columns]).alias("columns")
    return df.groupBy(part.alias("part")).agg(F.count("*").alias("n_rows"), cells)


def merged_profiles(parts: DataFrame, part: Column | None = None) -> DataFrame:
    """Part profiles of coarser parts, an expression of `part`; of the whole, whose part is NULL,
    without one. Several rows of one part, as later loads add them, become one."""

    def summary(name: str) -> Column:
        cell = F.col("columns")[name]
        return F.struct(
            F.min(cell["low"]).alias("low"),
            F.max(cell["high"]).alias("high"),
            F.coalesce(F.sum(cell["n_missing"]), F.lit(0)).alias("n_missing"),
            F.hll_union_agg(cell["sketch"]).alias("sketch"),
        ).alias(name)

    cells = F.struct(*[summary(c) for c in parts.schema["columns"].dataType.names])
    rows = F.coalesce(F.sum("n_rows"), F.lit(0))
    if part is not None:
        return parts.groupBy(part.alias("part")).agg(rows.alias("n_rows"), cells.alias("columns"))
    whole = F.lit(None).cast(parts.schema["part"].dataType).alias("part")
    return parts.agg(rows.alias("n_rows"), cells.alias("columns")).select(whole, "n_rows", "columns")


def profile_rows(parts: DataFrame) -> DataFrame:
    """Rows (part, column_name, n_distinct, min_value, max_value, n_missing, n_rows); n_distinct is
    the sketch's estimate, corners are rendered as text."""
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.hll_sketch_estimate(F.col("columns")[name]["sketch"]).alias("n_distinct"),
            F.col("columns")[name]["low"].cast("string").alias("min_value"),
            F.col("columns")[name]["high"].cast("string").alias("max_value"),
            F.col("columns")[name]["n_missing"].alias("n_missing"),
        )
        for name in parts.schema["columns"].dataType.names
    ]
    spread = parts.select("part", "n_rows", F.inline(F.array(*cells)))
    order = ["part", "column_name", "n_distinct", "min_value", "max_value", "n_missing", "n_rows"]
    return spread.select(*order)
