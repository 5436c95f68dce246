"""Versions of a key: what was known of it at an instant, and how it came to be known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_text(columns: list[str]) -> Column:
    """A row as JSON, null fields included; also of columns without an order, such as documents."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def latest(rows: DataFrame, key: list[str], knowledge: str, tie: list[str] | None = None) -> DataFrame:
    """Each key in its version of the latest knowledge; a version without an instant comes first of all.

    Versions known at the same instant are told apart by the largest `tie`, then by their text, so
    the answer does not depend on the order of the rows. Null keys are one key. The maximum is taken
    in every task before the shuffle, so a key of any number of versions arrives as one row a task.
    """
    others = [c for c in rows.columns if c not in key]
    if not others:
        raise ValueError("a version needs a column beside its key")
    order = F.struct(knowledge, *(tie or []), row_text(others))
    found = rows.groupBy(*key).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return found.select(*key, "_row.*").select(*rows.columns)


def known_at(
    rows: DataFrame, key: list[str], knowledge: str, at, tie: list[str] | None = None
) -> DataFrame:
    """Each key as it was known at an instant: `latest` of the versions known at or before it.

    Keys first known later are absent; a version without an instant is never known. The bound is a
    literal on the bare column, so it reaches the scan.
    """
    bound = F.lit(at).cast(rows.schema[knowledge].dataType)
    return latest(rows.where(F.col(knowledge) <= bound), key, knowledge, tie)


def restated(rows: DataFrame, key: list[str], knowledge: str) -> DataFrame:
    """Keys that have several versions: key columns, n_versions, first_known, last_known.

    A version is a distinct row; copies do not count.
    """
    others = [c for c in rows.columns if c not in key]
    digest = F.md5(row_text(others))
    distinct = rows.groupBy(*key, digest.alias("_digest")).agg(F.max(knowledge).alias("_known"))
    found = distinct.groupBy(*key).agg(
        F.count("*").alias("n_versions"),
        F.min("_known").alias("first_known"),
        F.max("_known").alias("last_known"),
    )
    return found.where("n_versions > 1")
