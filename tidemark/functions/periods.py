"""Period strings of mixed frequency to period dates, one native expression.

The format is decided row by row, so a column may mix frequencies. Every period
maps to its last day, except two-month periods, which map to their first day, and
weeks, which map to their Saturday (weeks start on Monday, week 0 holds the days
before the first Monday), and full dates, which stay. Blanks around a period do not count. A string of no known format gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names as they may be written, in calendar order.
MONTH_NAMES = [
    "jan(uary)?", "feb(ruary)?", "mar(ch)?", "apr(il)?", "may", "june?",
    "july?", "aug(ust)?", "sept?(ember)?", "oct(ober)?", "nov(ember)?", "dec(ember)?",
]
_MONTHS = "|".join(MONTH_NAMES)
_MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = r"^\d{4}([-/.]?M(0?[1-9]|1[0-2])|[-/.](0[1-9]|1[0-2]))$"
_NAMED_MONTH = rf"(?i)^(({_MONTHS}) \d{{4}}|\d{{4}} ({_MONTHS}))$"

_SPLIT_DATE = r"^\d{4}([/.])\d{2}\1\d{2}$"
_NAMED_DATE = rf"(?i)^({_MONTHS})\.? \d{{1,2}}, ?\d{{4}}$"


def _dashed(digits: Column) -> Column:
    parts = (F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return F.concat_ws("-", *parts)


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _week_saturday(year: Column, week: Column) -> Column:
    new_year = F.make_date(year, F.lit(1), F.lit(1))
    saturday = F.date_add(F.trunc(F.date_add(new_year, week * 7 - 1), "week"), 5)
    # A year that starts on a Monday has no week 0, which would end on 30 December.
    return F.when((week > 0) | (F.dayofmonth(saturday) != 30), saturday)


def period_date(column) -> Column:
    """Date of the period named by a string column.

    Each format is recognised by a regular expression behind a cheap test of length
    or of one character, so a row meets about one expression. All formats that end
    with a month share one date expression, which keeps the generated code below
    the size from which the JVM leaves it uncompiled.
    """
    p = F.trim(F.col(column) if isinstance(column, str) else column)
    size, fifth, sixth = F.length(p), F.substring(p, 5, 1), F.substring(p, 6, 1)
    year = _number(F.substring(p, 1, 4))
    tail = _number(F.regexp_extract(p, r"(\d{1,2})$", 1))
    last = _number(F.right(p, F.lit(1)))
    month_start = F.lower(F.regexp_extract(p, "([A-Za-z]{3})", 1))
    named_month = F.floor((F.instr(F.lit(_MONTH_STARTS), month_start) + 2) / 3).cast("int")
    last_month = (
        F.when((sixth.isin("0", "1", "M") | (fifth == "M")) & p.rlike(_MONTH), tail)
        .when(((fifth == "Q") | (sixth == "Q")) & p.rlike(r"^\d{4}-?Q[1-4]$"), last * 3)
        .when((size == 4) & p.rlike(r"^\d{4}$"), F.lit(12))
        .when((sixth == "S") & p.rlike(r"^\d{4}-S[12]$"), last * 6)
        .when((size == 7) & p.rlike(r"^Q[1-4] \d{4}$"), _number(F.substring(p, 2, 1)) * 3)
        .when((size >= 8) & p.rlike(_NAMED_MONTH), named_month)
    )
    leading = F.when(p.rlike(r"^\d{4}"), F.substring(p, 1, 4))
    year_of_month = _number(leading.when(p.rlike(r"\d{4}$"), F.right(p, F.lit(4))))
    short_year = F.substring(p, 1, 2)
    day = F.lpad(F.regexp_extract(p, r"(\d+),", 1), 2, "0")
    month = F.lpad(named_month.cast("string"), 2, "0")
    named_date = F.concat_ws("-", F.right(p, F.lit(4)), month, day).try_cast("date")
    century = F.when(short_year >= "69", "19").otherwise("20")
    short_date = F.concat(
        century, short_year, F.lit("-"), F.substring(p, 3, 2), F.lit("-"), F.right(p, F.lit(2))
    )
    return (
        F.when(
            (size >= 10) & p.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"),
            F.substring(p, 1, 10).try_cast("date"),
        )
        .when(
            (size == 10) & fifth.isin("/", ".") & p.rlike(_SPLIT_DATE),
            F.translate(p, "/.", "--").try_cast("date"),
        )
        .when((size == 8) & p.rlike(r"^\d{8}$"), _dashed(p).try_cast("date"))
        .when((size >= 10) & p.rlike(_NAMED_DATE), named_date)
        .when(
            (sixth == "W") & p.rlike(r"^\d{4}-W([0-4]?\d|5[0-3])$"), _week_saturday(year, tail)
        )
        .when(
            (sixth == "B") & p.rlike(r"^\d{4}-B[1-6]$"),
            F.make_date(year, last * 2 - 1, F.lit(1)),
        )
        .when((size == 6) & p.rlike(r"^\d{6}$"), short_date.try_cast("date"))
        .otherwise(F.last_day(F.make_date(year_of_month, last_month, F.lit(1))))
    )


def with_period(df: DataFrame, source: str = "original_period", to: str = "period") -> DataFrame:
    return df.withColumn(to, period_date(source))


def period_shape(column) -> Column:
    """The string with digits as 9 and letters as A, to group rejects by format."""
    p = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(F.regexp_replace(p, r"\d", "9"), "[A-Za-z]", "A")


def rejected_periods(df: DataFrame, source: str = "original_period") -> DataFrame:
    """Number of strings that give no date, per shape."""
    dated = with_period(df.select(source), source, "_period")
    rejected = F.col("_period").isNull() & F.col(source).isNotNull()
    return (
        dated.groupBy(F.when(rejected, period_shape(source)).alias("shape"))
        .agg(F.count_if(rejected).alias("n_rows"))
        .where("n_rows > 0")
    )
