"""High-water marks that know the keys seen at their instant, so ties are loaded once and only once.

A mark is a table (instant, *keys): all keys loaded at the latest instant. It holds the ties of one
instant only, and stays a distributed table, as a feed may stamp very many rows alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import exists, folder_names

ROWS, MARKS, LOAD = "rows", "marks", "load"


def rows_beyond(
    source: DataFrame, column: str, keys: Sequence[str], mark: DataFrame | None = None
) -> DataFrame:
    """Rows known after the mark's instant, and rows at it whose key the mark has not seen.

    Without a mark, or with an empty one, all rows that have an instant. Rows without one are never
    beyond a mark. A NULL in a key equals another. Both filters reach the scan; only the ties meet
    the mark, so the newer rows are not shuffled.
    """
    if mark is None or mark.isEmpty():
        return source.where(F.col(column).isNotNull())
    instant = mark.agg(F.max(column)).scalar()
    newer = source.where(F.col(column) > instant)
    at = source.where(F.col(column) == instant)
    seen = mark.where(F.col(column) == instant).select(
        *[F.col(k).alias(f"_seen{i}") for i, k in enumerate(keys)]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_seen{i}")) for i, k in enumerate(keys)]
    return newer.unionByName(at.join(seen, same, "left_anti"))


def mark_after(
    loaded: DataFrame, column: str, keys: Sequence[str], mark: DataFrame | None = None
) -> DataFrame:
    """The mark once `loaded` is in: its keys at the latest instant, with those of the mark before if
    that is the same one. A load without rows leaves the mark as it was."""
    reached = loaded.select(column, *keys)
    if mark is not None:
        reached = reached.unionByName(mark.select(column, *keys))
    return reached.where(F.col(column) == reached.agg(F.max(column)).scalar()).distinct()


def _loads(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the loads that ended: those whose mark is whole."""
    names = folder_names(spark, f"{target}/{MARKS}")
    whole = [n for n in names if exists(spark, f"{target}/{MARKS}/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix(f"{LOAD}-")) for n in whole)


def load_once(source: DataFrame, column: str, keys: Sequence[str], target: str) -> int:
    """Adds to a target what a source holds beyond its mark, and moves the mark; the load's number.

    Rows are written first, the mark last. A load that broke off in between has no mark: nobody reads
    its rows, and the next one takes its number and overwrites them.
    """
    spark = source.sparkSession
    done = _loads(spark, target)
    number = done[-1] + 1 if done else 0
    mark = None
    if done:
        shape = T.StructType([source.schema[c] for c in (column, *keys)])
        mark = spark.read.schema(shape).parquet(f"{target}/{MARKS}/{LOAD}-{done[-1]}")
    path = f"{target}/{ROWS}/{LOAD}-{number}"
    rows_beyond(source, column, keys, mark).write.mode("overwrite").parquet(path)
    loaded = spark.read.schema(source.schema).parquet(path)
    reached = mark_after(loaded, column, keys, mark)
    reached.write.mode("overwrite").parquet(f"{target}/{MARKS}/{LOAD}-{number}")
    return number


def read_loaded(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All rows of the loads that ended."""
    paths = [f"{target}/{ROWS}/{LOAD}-{n}" for n in _loads(spark, target)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_load(spark: SparkSession, target: str, schema: T.StructType, number: int) -> DataFrame:
    """The rows that one load added."""
    return spark.read.schema(schema).parquet(f"{target}/{ROWS}/{LOAD}-{number}")
