"""Unions and comparisons of key sets, frames and ordered lists.

Both sides are stacked with a side mark and aggregated by key: one shuffle with
map-side combine, so a hot key arrives as one row per task and side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import tidy_lines
from tidemark.session import stored


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Bag union, columns by name, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _sides(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the number of rows on each side."""
    marked = left.select(*keys, F.lit(1).alias("_left"), F.lit(0).alias("_right")).unionByName(
        right.select(*keys, F.lit(0).alias("_left"), F.lit(1).alias("_right"))
    )
    return marked.groupBy(*keys).agg(
        F.sum("_left").alias("n_left"), F.sum("_right").alias("n_right")
    )


def set_diff_report(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Sizes of both sets, their intersection and both differences, in one row."""
    in_left, in_right = F.col("n_left") > 0, F.col("n_right") > 0
    return _sides(left, right, list(keys)).agg(
        F.count_if(in_left).alias("n_left"),
        F.count_if(in_right).alias("n_right"),
        F.count_if(in_left & in_right).alias("n_both"),
        F.count_if(in_left & ~in_right).alias("n_left_only"),
        F.count_if(~in_left & in_right).alias("n_right_only"),
    )


def difference(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys of `left` that `right` lacks."""
    return _sides(left, right, list(keys)).where("n_left > 0 AND n_right = 0").select(*keys)


def intersection(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    return _sides(left, right, list(keys)).where("n_left > 0 AND n_right > 0").select(*keys)


def set_relations(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """One row: is left a subset, are the sets equal, are they disjoint."""
    report = set_diff_report(left, right, *keys)
    return report.select(
        (F.col("n_left_only") == 0).alias("is_subset"),
        ((F.col("n_left_only") == 0) & (F.col("n_right_only") == 0)).alias("is_equal"),
        (F.col("n_both") == 0).alias("is_disjoint"),
    )


def reconcile(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Keys that only one of two extracts holds, with the side that has them."""
    one_sided = _sides(left, right, list(keys)).where("n_left = 0 OR n_right = 0")
    side = F.when(F.col("n_left") > 0, "left_only").otherwise("right_only")
    return one_sided.select(*keys, side.alias("side"))


def blank_blind(column) -> Column:
    """Value as text for fuzzy comparison: line by line, blanks tidied, blank lines left out."""
    c = F.col(column) if isinstance(column, str) else column
    return tidy_lines(c.cast("string"))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (column_name, left_type, right_type) of columns that only one frame has, or that differ
    in type."""
    here, there = ({f.name: f.dataType.simpleString() for f in df.schema} for df in (left, right))
    rows = [(n, here.get(n), there.get(n)) for n in here | there if here.get(n) != there.get(n)]
    return left.sparkSession.createDataFrame(
        rows, "column_name string, left_type string, right_type string"
    )


def _holds(kind: T.DataType, *kinds: type) -> bool:
    """Whether a type is, or has inside it, one of the kinds."""
    if isinstance(kind, kinds):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, *kinds)
    if isinstance(kind, T.MapType):
        return _holds(kind.keyType, *kinds) or _holds(kind.valueType, *kinds)
    return isinstance(kind, T.StructType) and any(_holds(f.dataType, *kinds) for f in kind.fields)


def comparable(df: DataFrame) -> DataFrame:
    """Columns that cannot be grouped by in a form that can: documents, and what holds documents or maps,
    as JSON (of a document, keys are in order); a map of plain values as its sorted entries."""

    def form(field: T.StructField) -> Column:
        c, kind = F.col(field.name), field.dataType
        if not _holds(kind, T.VariantType, T.MapType):
            return c
        if isinstance(kind, T.MapType) and not _holds(
            T.StructType([T.StructField("k", kind.keyType), T.StructField("v", kind.valueType)]),
            T.VariantType,
            T.MapType,
        ):
            return F.array_sort(F.map_entries(c)).alias(field.name)
        return F.to_json(c, {"ignoreNullFields": "false"}).alias(field.name)

    return df.select(*[form(f) for f in df.schema.fields])


def _restored(found: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `comparable` in their own types again."""

    def own(field: T.StructField) -> Column:
        c, kind = F.col(field.name), field.dataType
        if found.schema[field.name].dataType == kind:
            return c
        if isinstance(kind, T.VariantType):
            return F.parse_json(c).alias(field.name)
        if isinstance(found.schema[field.name].dataType, T.ArrayType):
            return F.map_from_entries(c).alias(field.name)
        return F.from_json(c, kind).alias(field.name)

    counts = [c for c in found.columns if c not in schema.names]
    return found.select(*[own(f) for f in schema.fields], *counts)


def bucket_digests(df: DataFrame, buckets: int = 4096) -> DataFrame:
    """(bucket, n_rows, digest1, digest2): per bucket of row hashes, the count of its rows and the sums
    of two hashes of each, whatever their order; one row a bucket, added up in every task first."""
    columns = sorted(df.columns)
    rows = comparable(df)
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    hashed = rows.select(
        F.pmod(one, F.lit(buckets)).cast("int").alias("bucket"),
        one.cast("decimal(20,0)").alias("one"),
        two.cast("decimal(20,0)").alias("two"),
    )
    return hashed.groupBy("bucket").agg(
        F.count("*").alias("n_rows"), F.sum("one").alias("digest1"), F.sum("two").alias("digest2")
    )


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = 4096) -> DataFrame:
    """Buckets in which the digests of two frames of the same columns and types differ."""
    sides = bucket_digests(left, buckets).unionByName(bucket_digests(right, buckets))
    figures = F.struct("n_rows", "digest1", "digest2")
    found = sides.groupBy("bucket").agg(
        F.count("*").alias("sides"), F.min(figures).alias("low"), F.max(figures).alias("high")
    )
    return found.where("sides = 1 OR low <> high").select("bucket")


def frame_digest_diff(left: DataFrame, right: DataFrame, buckets: int = 4096) -> DataFrame:
    """`frame_diff` that shuffles only rows of buckets whose digests differ.

    Both frames are scanned for their digests, of which `buckets` rows a side are shuffled. Equal
    frames end there: their rows are filtered away in the scan, before any exchange. Frames of other
    columns or types go to `frame_diff`.
    """
    here, there = ({f.name: f.dataType for f in df.schema} for df in (left, right))
    if here != there:
        return frame_diff(left, right)
    # written, so that the digests are computed once; at most one row a bucket
    found = F.broadcast(stored(differing_buckets(left, right, buckets)))
    columns = sorted(left.columns)

    def of_them(df: DataFrame) -> DataFrame:
        rows = comparable(df).withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))
        return rows.join(found, F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket")

    differing = _sides(of_them(left), of_them(right), left.columns).where("n_left <> n_right")
    return _restored(differing, left.schema)


def frames_digest_equal(left: DataFrame, right: DataFrame, buckets: int = 4096) -> bool:
    """Do two frames have the same columns, types and rows, by their digests alone."""
    if not schema_diff(left, right).isEmpty():
        return False
    return differing_buckets(left, right, buckets).isEmpty()


def frame_diff(left: DataFrame, right: DataFrame, fuzzy: bool = False) -> DataFrame:
    """Rows whose number of copies differs, with both counts.

    Copies stay a count, so a row repeated a billion times is one result row. Frames with other
    columns, or other types unless `fuzzy`, share no row: all their rows differ, shown with the
    columns of both, as text where the types differ. Empty frames have no rows to show, so equality
    is `frames_equal`.
    """
    if fuzzy:
        left, right = (df.select(*[blank_blind(c).alias(c) for c in df.columns]) for df in (left, right))
    here, there = ({f.name: f.dataType for f in df.schema} for df in (left, right))
    columns = list(here | there)
    if here == there:
        found = _sides(comparable(left), comparable(right), columns).where("n_left <> n_right")
        return _restored(found, left.schema)

    def shown(df, own, other):
        return comparable(df).select(
            *[
                (F.col(c) if c not in other or other[c] == own[c] else F.col(c).cast("string")).alias(c)
                if c in own
                else F.lit(None).cast(others[c]).alias(c)
                for c in columns
            ]
        )

    shape = "_columns"
    others = {f.name: f.dataType for df in (left, right) for f in comparable(df).schema}
    left = shown(left, here, there).withColumn(shape, F.lit(0))
    right = shown(right, there, here).withColumn(shape, F.lit(1))
    return _sides(left, right, [*columns, shape]).drop(shape)


def frames_equal(left: DataFrame, right: DataFrame, fuzzy: bool = False) -> bool:
    """Do two frames have the same columns, the same types unless `fuzzy`, and the same rows."""
    if set(left.columns) != set(right.columns):
        return False
    if not fuzzy and not schema_diff(left, right).isEmpty():
        return False
    return frame_diff(left, right, fuzzy).isEmpty()


def ordered_diff(left: DataFrame, right: DataFrame, position: list[str], value: str) -> DataFrame:
    """Positions at which two lists differ, or which one list lacks."""
    sided = [
        df.select(
            *position,
            F.when(F.lit(is_left), F.col(value)).alias("_left"),
            F.when(F.lit(not is_left), F.col(value)).alias("_right"),
            F.lit(int(is_left)).alias("_in_left"),
            F.lit(int(not is_left)).alias("_in_right"),
        )
        for df, is_left in ((left, True), (right, False))
    ]
    paired = (
        sided[0]
        .unionByName(sided[1])
        .groupBy(*position)
        .agg(
            F.max("_left").alias("left_value"),
            F.max("_right").alias("right_value"),
            F.max("_in_left").alias("_in_left"),
            F.max("_in_right").alias("_in_right"),
        )
    )
    same = (F.col("_in_left") == F.col("_in_right")) & F.col("left_value").eqNullSafe(
        F.col("right_value")
    )
    return paired.where(~same).drop("_in_left", "_in_right")
