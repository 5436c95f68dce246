"""Validity-interval mapping between filer key and company key.

`effdate` and `thrudate` are both inclusive; an open interval ends 2100-12-31.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import guards
from tidemark.functions.conform import pad_key
from tidemark.operators import sweep

CIK_WIDTH = 10
GVK_WIDTH = 6


def mapping_as_of(
    id_map: DataFrame, cik=None, gvk=None, as_of_date: str | None = None
) -> DataFrame:
    """Mapping rows of the given keys, valid on the day; no day means all rows."""
    for column, width, value in (("cik", CIK_WIDTH, cik), ("gvk", GVK_WIDTH, gvk)):
        keys = guards.clean_ids(column, value)
        if keys is not None:
            id_map = id_map.where(F.col(column).isin([str(k).zfill(width) for k in keys]))
    if as_of_date is not None:
        day = F.lit(as_of_date).cast(id_map.schema["effdate"].dataType)
        id_map = id_map.where((F.col("effdate") <= day) & (day <= F.col("thrudate")))
    return id_map


def gvk_from_cik(id_map: DataFrame, cik, as_of_date: str | None = None) -> DataFrame:
    return mapping_as_of(id_map, cik=cik, as_of_date=as_of_date)


def cik_from_gvk(id_map: DataFrame, gvk, as_of_date: str | None = None) -> DataFrame:
    return mapping_as_of(id_map, gvk=gvk, as_of_date=as_of_date)


def attach_as_of(
    facts: DataFrame,
    id_map: DataFrame,
    key: str,
    at: str,
    how: str = "left",
    bucket_days: int = 365,
) -> DataFrame:
    """Facts with the mapping row valid at the instant `at`.

    Key and time bucket form the equi-join key: each interval is laid out over the
    buckets it shares with the facts, which spreads a hot key over time, bounds the
    candidates a fact meets and keeps the join a hash or merge join. Keys that change
    often want small buckets. One more scan of the single column `at` finds the first and
    last day of the facts.
    """

    def bucket(moment) -> Column:
        return F.floor(F.unix_date(F.to_date(moment)) / bucket_days).cast("int")

    ends = F.struct(bucket(F.min(at)).alias("low"), bucket(F.max(at)).alias("high"))
    limits = facts.agg(ends).scalar()
    laid_out = (
        id_map.withColumn("_limits", limits)
        .withColumn("_first", F.greatest(bucket("effdate"), F.col("_limits.low")))
        .withColumn("_last", F.least(bucket("thrudate"), F.col("_limits.high")))
        .where("_first <= _last")
        .withColumn("_bucket", F.explode(F.sequence("_first", "_last")))
        .drop("_limits", "_first", "_last")
        .alias("m")
    )
    left = facts.withColumn("_bucket", bucket(at)).alias("f")
    match = (
        (F.col(f"f.{key}") == F.col(f"m.{key}"))
        & (F.col("f._bucket") == F.col("m._bucket"))
        & (F.col("m.effdate") <= F.col(f"f.{at}"))
        & (F.col(f"f.{at}") <= F.col("m.thrudate"))
    )
    attached = [F.col(f"m.{c}").alias(c) for c in id_map.columns if c != key]
    return left.join(laid_out, match, how).select(
        *[F.col(f"f.{c}").alias(c) for c in facts.columns], *attached
    )


def mapping_conflicts(
    id_map: DataFrame, key: str, step: str = "1 DAY", low: str = "effdate", high: str = "thrudate"
) -> DataFrame:
    """(key, kind, first, last): what keeps a key from having one mapping row on every day between its
    first and its last.

    `overlap`: days that an earlier row covers too; `gap`: days that no row covers; `inverted`: a
    row that ends before it begins, which covers nothing. Both ends are inclusive and move in
    steps of `step`. Rows of a key are swept in order over as many tasks as they need; equal rows
    overlap each other, rows without an end point take no part.
    """
    rows = id_map.select(key, F.col(low).alias("first"), F.col(high).alias("last"))
    one = F.expr(f"INTERVAL {step}")
    kind = rows.schema["first"].dataType
    inverted = rows.where("last < first").select(key, F.lit("inverted").alias("kind"), "first", "last")
    swept = sweep.with_reach(rows.where("first <= last"), [key], ["first", "last"], "last")
    swept, reached = swept.where("reached is not null"), F.col("reached")
    overlap = F.struct(
        F.lit("overlap").alias("kind"), F.col("first"), F.least("last", reached).alias("last")
    )
    gap = F.struct(
        F.lit("gap").alias("kind"),
        (reached + one).cast(kind).alias("first"),
        (F.col("first") - one).cast(kind).alias("last"),
    )
    found = swept.select(key, F.explode(F.array(overlap, gap)).alias("_found")).select(key, "_found.*")
    return found.where("first <= last").unionByName(inverted)


def padded_keys(df: DataFrame, cik: str = "cik", gvk: str | None = None) -> DataFrame:
    """Integer keys in the padded form the mapping tables use."""
    df = df.withColumn(cik, pad_key(cik, CIK_WIDTH))
    return df if gvk is None else df.withColumn(gvk, pad_key(gvk, GVK_WIDTH))
