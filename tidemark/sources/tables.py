"""Lake tables by name, with a declared schema where there is one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.conform import conform_marked, marked_failures
from tidemark.operators.windows import FILING_ZONE
from tidemark.session import stored


def read_table(
    spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    return [f.getPath().getName() for f in system.listStatus(place) if f.isDirectory()]


def make_folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)


def filing_day(df: DataFrame, column: str = "filing_date") -> Column:
    """Day of a filing in the filing zone, whatever the zone of the session."""
    if not isinstance(df.schema[column].dataType, T.TimestampType):
        return F.to_date(column)
    seconds = (F.unix_micros(column) / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(str(FILING_ZONE)), utc))


def with_filing_day(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Child rows with the filing day of their filing, by which they are stored; `parent` has one
    row per uuid."""
    days = parent.select("uuid", "filing_date")
    return child.drop("filing_date").join(days, "uuid")


def store_vintages(
    vintages: list[DataFrame], schema: T.StructType, path: str, family: str
) -> DataFrame:
    """Store the vintages of a table in its declared schema; the values that did not read as
    declared come back as (vintage, column_name, n_failed).

    A vintage is read and conformed once: its rows are written with the names of what did not read,
    and laid out and counted from there.
    """
    conformed = stored(conform_marked(vintages, schema))
    write_filings(conformed.select(*schema.names), path, family)
    return marked_failures(conformed)


def write_filings(df: DataFrame, path: str, family: str) -> None:
    """Store a filing table by family and filing month, sorted so that scans for a
    security, a filer or a window skip row groups, with bloom filters for the look-up keys."""
    layout = [schemas.FAMILY, schemas.FILING_MONTH]
    # Security, filer, day and uuid spread a crowded month over several writers.
    order = layout + [c for c in ("cusip", "cik", "filing_date", "uuid") if c in df.columns]
    (
        df.withColumn(schemas.FAMILY, F.lit(family))
        .withColumn(schemas.FILING_MONTH, F.date_format(filing_day(df), "yyyy-MM"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("append")
        .partitionBy(*layout)
        .option("parquet.bloom.filter.enabled#uuid", "true")
        .option("parquet.bloom.filter.enabled#cusip", "true")
        .parquet(path)
    )


def write_catalog(catalog: list[DataFrame], points: list[DataFrame], folder: str) -> DataFrame:
    """Store the vintages of a series catalog and of its points in their declared schemas; what did
    not read comes back as (table_name, vintage, column_name, n_failed).

    Both lie by series, the points of a long one over several files, so a look-up by id skips files
    and row groups.
    """
    lost = []
    for name, vintages, schema in (
        ("catalog", catalog, schemas.CATALOG),
        ("series", points, schemas.SERIES_VALUES),
    ):
        order = ["payload_id", "commodity" if name == "catalog" else "original_period"]
        conformed = stored(conform_marked(vintages, schema))
        (
            conformed.select(*schema.names)
            .repartitionByRange(*order, "name" if name == "catalog" else "value")
            .sortWithinPartitions(*order)
            .write.option("parquet.bloom.filter.enabled#payload_id", "true")
            .parquet(f"{folder}/{name}.parquet")
        )
        lost.append(marked_failures(conformed).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, lost)


def read_filings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored filing table with its two layout columns, which filters prune by."""
    layout = schemas.struct(
        **{schemas.FAMILY: schemas.STRING, schemas.FILING_MONTH: schemas.STRING}
    )
    return spark.read.schema(T.StructType([*schema.fields, *layout.fields])).parquet(path)
