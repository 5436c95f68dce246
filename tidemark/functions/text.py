"""Line-wise text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space within a line.
INNER_BLANKS = r"[\t\x0B\f\r ]+"


def _column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def explode_lines(
    df: DataFrame, text: str, line: str = "line", position: str = "line_no"
) -> DataFrame:
    """One row per line of a text, numbered from 0."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(F.split(F.col(text), "\n")).alias(position, line))


def tidy_line(line: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(line, INNER_BLANKS, " "))


def tidy_lines(column) -> Column:
    """Every line of a text tidied, blank lines left out; lines stay apart."""
    lines = F.transform(F.split(_column(column), "\n"), tidy_line)
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def drop_lines(df: DataFrame, regex: str | None, line: str = "line") -> DataFrame:
    """Lines a regular expression is not found in; no expression keeps them all."""
    return df if regex is None else df.where(~F.col(line).rlike(regex))


def clean_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Blanks collapsed and trimmed, blank lines dropped.

    The test for blank lines reads the raw line: a test of the cleaned one would be
    pushed below and clean every line twice.
    """
    cleaned = F.trim(F.regexp_replace(F.col(line), r"\s+", " "))
    return df.where(F.col(line).rlike(r"\S")).withColumn(line, cleaned)
