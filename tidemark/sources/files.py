"""JSON, text and id-list files, and file selection in a tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The writer's own formats stop at milliseconds.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**MICROSECONDS).json(path)


# A file of pages is read by one task, whole where it may be one pretty-printed page, so its size
# must not grow with the table.
PAGES_PER_FILE = 100


def write_pages(pages: DataFrame, path: str, pages_per_file: int = PAGES_PER_FILE) -> None:
    """Landed pages, one a line, gzipped in files of a bounded number of pages."""
    writer = pages.write.mode("overwrite").options(**MICROSECONDS)
    writer.option("maxRecordsPerFile", pages_per_file).option("compression", "gzip").json(path)


def write_page_texts(pages: DataFrame, path: str, pages_per_file: int = PAGES_PER_FILE) -> None:
    """`write_pages` of pages that are texts already."""
    writer = pages.write.mode("overwrite").option("lineSep", "\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", pages_per_file).text(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """One object per line, or one per file with `multi_line`."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def write_text(lines: DataFrame, path: str, gzip: bool = False, append: bool = False) -> None:
    """One text column, one line per row. Gzip files cannot be split on reading, so
    their size is set by the number of partitions written."""
    writer = lines.write.mode("append" if append else "overwrite").option("lineSep", "\n")
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.text(path)


def read_text(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Lines as `value`; bytes that are not UTF-8 raise, or stay with strict off."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.validate_utf8("value").alias("value")) if strict else lines


def read_universe(spark: SparkSession, path: str, name: str = "cik") -> DataFrame:
    """Integer ids, one per line."""
    return spark.read.text(path).select(F.trim("value").cast("bigint").alias(name))


def read_ragged_columns(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """`{column: [values]}` documents with columns of unequal length; the rows of a
    document line up by position, short columns end in NULL."""
    columns = [f.name for f in schema.fields]
    documents = read_json(spark, path, schema, multi_line)
    full = [
        F.coalesce(F.col(f.name), F.array().cast(f.dataType)).alias(f.name) for f in schema.fields
    ]
    return documents.select(*full).select(F.inline(F.arrays_zip(*columns)))


def select_files(
    spark: SparkSession, root: str, pattern: str, schema: T.StructType, regex: str | None = None
) -> DataFrame:
    """Rows of all JSON files below `root` whose name fits the glob pattern and
    whose path fits the regular expression, with the path of origin."""
    files = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .json(root)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )
    return files if regex is None else files.where(F.col("file_path").rlike(regex))
