"""Landed response pages: row ingest, multi-table merge, completeness, rejects.

Pages are read as text and parsed once, so a page that cannot be read is seen:
it goes to the rejects or, where a caller takes no rejects, stops the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import sweep
from tidemark.operators.joins import lookup
from tidemark.session import stored

CORRUPT = "_corrupt"
# A body is parsed as one member of an object whose other member follows it: the parser would stop
# after the first value of a text and pass over the rest, here that is an error.
BODY, END = "tidemark_body", "tidemark_end"


def _closed(body: Column) -> Column:
    return F.concat(F.lit(f'{{"{BODY}":'), body, F.lit(f',"{END}":true}}'))


def is_one_value(body: Column) -> Column:
    """Whether a text is one JSON value, with nothing behind it."""
    closed = F.from_json(_closed(body), schemas.struct(**{END: T.BooleanType()}))
    return F.coalesce(closed[END], F.lit(False))


def parsed_bodies(
    bodies: DataFrame, row: T.StructType, body: str, required: tuple[str, ...]
) -> tuple[DataFrame, Column]:
    """Bodies with the parsed `_row`, and whether a body does not fit or has more behind it.

    The parsed row passes through a generator, which filters stay above: they
    would otherwise move below it and parse each text again.
    """
    fields = schemas.struct(**{BODY: row, END: T.BooleanType(), CORRUPT: T.StringType()})
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    closed = F.from_json(_closed(F.col(body)), fields, options)
    parsed = bodies.select("*", F.explode(F.array(closed)).alias("_closed"))
    parsed = parsed.select("*", F.col(f"_closed.{BODY}").alias("_row"))
    bad = (
        F.col("_row").isNull()
        | F.col(f"_closed.{END}").isNull()
        | F.col(f"_closed.{CORRUPT}").isNotNull()
    )
    for name in required:
        bad = bad | F.col(f"_row.{name}").isNull()
    return parsed, bad


def parse_rows(
    bodies: DataFrame, row: T.StructType, body: str = "value", required: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON texts; a text that does not fit, or lacks a required
    field, goes to the rejects."""
    parsed, bad = parsed_bodies(bodies, row, body, required)
    others = [c for c in bodies.columns if c != body]
    rows = parsed.where(~bad).select(*others, *[f"_row.{f.name}" for f in row.fields])
    return rows, parsed.where(bad).select(*others, body)


def split_pages(
    spark: SparkSession, path: str, row: T.StructType, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(pages, rejects) of a landing folder; error bodies and cut-off files are rejected."""
    bodies = spark.read.text(path, wholetext=multi_line)
    return parse_rows(bodies, schemas.envelope(row), required=("data",))


def read_pages(
    spark: SparkSession, path: str, row: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Page envelopes: one per line, or one per file with `multi_line`.

    A page that cannot be read raises an error; `split_pages` sets such pages aside.
    """
    return _readable(spark.read.text(path, wholetext=multi_line), schemas.envelope(row))


def _readable(bodies: DataFrame, envelope: T.StructType) -> DataFrame:
    parsed, bad = parsed_bodies(bodies, envelope, "value", ("data",))
    message = F.concat(F.lit("unreadable page: "), F.left("value", F.lit(200)))
    checked = F.when(bad, F.raise_error(message)).otherwise(F.col("_row"))
    pages = parsed.select(F.explode(F.array(checked)).alias("page"))
    return pages.select(*[f"page.{f.name}" for f in envelope.fields])


def page_rows(pages: DataFrame) -> DataFrame:
    """Union of the rows of all pages."""
    return pages.select(F.inline("data"))


def page_offset(self_link="links.self") -> Column:
    """Offset a page started at, 0 when its link names none."""
    c = F.col(self_link) if isinstance(self_link, str) else self_link
    offset = F.try_parse_url(c, F.lit("QUERY"), F.lit("offset"))
    return F.coalesce(offset.try_cast("bigint"), F.lit(0).cast("bigint"))


def page_request(self_link="links.self") -> Column:
    """Link without its offset: the request a page belongs to.

    The parameter goes wherever it stands; the others keep their order.
    """
    c = F.col(self_link) if isinstance(self_link, str) else self_link
    address = F.substring_index(c, "?", 1)
    asked = F.split(F.substring(c, F.length(address) + 2, F.length(c)), "&")
    kept = F.filter(asked, lambda part: (part != "") & ~part.startswith("offset="))
    return F.when(F.size(kept) == 0, address).otherwise(
        F.concat(address, F.lit("?"), F.array_join(kept, "&"))
    )


def page_completeness(pages: DataFrame) -> DataFrame:
    """Per request: pages and rows received against the announced total.

    Complete are requests of which the row counts agree, one page is the last, no page came twice and
    every page that another one names as the next came: a page that was repeated does not make up
    for one that was lost. Pages are counted by where they start, then by request, so a request of
    any number of pages is spread. `page_gaps` lists what is missing or doubled.
    """
    n = F.coalesce(F.size("data"), F.lit(0)).cast("bigint")
    received = F.struct(
        page_offset().alias("start"), F.lit(1).alias("came"), n.alias("n"), F.lit(0).alias("named")
    )
    following = F.struct(
        page_offset("links.next").alias("start"),
        F.lit(0).alias("came"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(1).alias("named"),
    )
    last = F.col("links.next").isNull()
    starts = pages.select(
        page_request().alias("request"),
        F.col("count").alias("announced"),
        last.cast("int").alias("last"),
        F.explode(F.when(last, F.array(received)).otherwise(F.array(received, following))).alias("_at"),
    )
    starts = starts.groupBy("request", "_at.start").agg(
        F.sum("_at.came").alias("came"),
        F.sum("_at.n").alias("n"),
        F.max("_at.named").alias("named"),
        F.max("announced").alias("announced"),
        F.sum(F.col("last") * F.col("_at.came")).alias("last"),
    )
    lost, twice = (F.col("named") == 1) & (F.col("came") == 0), F.col("came") > 1
    return starts.groupBy("request").agg(
        F.sum("came").alias("n_pages"),
        F.sum("n").alias("n_rows"),
        F.max("announced").alias("n_announced"),
        F.sum("last").alias("n_last_pages"),
        (
            (F.sum("n") == F.max("announced"))
            & (F.sum("last") == 1)
            & (F.count_if(lost) == 0)
            & (F.count_if(twice) == 0)
        ).alias("complete"),
    )


def page_gaps(pages: DataFrame) -> DataFrame:
    """(request, kind, low, high): ranges of offsets, high exclusive, that are `missing` between 0 and
    the announced total, that came more than once (`doubled`), or that lie `beyond` the total.

    A page of n rows at an offset is the range from there to n rows on. Copies of a range are counted
    first; the ranges of a request are then swept in order, over as many tasks as they need.
    """
    n = F.coalesce(F.size("data"), F.lit(0)).cast("bigint")
    ranges = pages.select(
        page_request().alias("request"), page_offset().alias("low"), n.alias("n"), F.col("count").alias("total")
    ).groupBy("request", "low", (F.col("low") + F.col("n")).alias("high"))
    ranges = ranges.agg(F.count("*").alias("copies"), F.max("total").alias("total"))
    totals = ranges.groupBy("request").agg(
        F.max("total").alias("announced"),
        F.max(F.when(F.col("high") > F.col("low"), F.col("high"))).alias("top")
    ).fillna(0, ["top"])
    totals = stored(totals)
    ranges = sweep.with_reach(ranges.where("high > low"), ["request"], ["low", "high"], "high")
    ranges = lookup(ranges, totals.select("request", "announced"), "request")
    total, reached = F.col("announced"), F.coalesce("reached", F.lit(0))

    def found(kind: str, low: Column, high: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"))

    at, end = F.col("low"), F.col("high")
    again = F.when(F.col("copies") > 1, end).otherwise(F.least(end, reached))
    kinds = F.array(
        found("missing", reached, F.least(at, total)),
        found("doubled", at, again),
        found("beyond", F.greatest(at, total), F.when(end > total, end)),
    )
    inner = ranges.select("request", F.inline(F.filter(kinds, lambda k: k["high"] > k["low"])))
    tail = totals.where("announced > top").select(
        "request", F.lit("missing").alias("kind"), F.col("top").alias("low"), F.col("announced").alias("high")
    )
    return inner.unionByName(tail)


def split_tables(
    spark: SparkSession, paths, tables: dict[str, T.StructType], multi_line: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(rows of every table, rejects) of multi-table pages, parsed once.

    The parsed pages are written to the shared folder by columns, so each table is read from
    there without the others; a page without a table adds no rows to it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    bodies = spark.read.text(paths, wholetext=multi_line)
    parsed, bad = parsed_bodies(bodies, schemas.table_envelope(tables), "value", ("data",))
    landed = stored(
        parsed.select(
            F.when(~bad, F.col("_row.data")).alias("data"), F.when(bad, F.col("value")).alias("value")
        )
    )
    rejects = landed.where("value is not null").select("value")
    return table_rows(landed, tables), rejects


def table_rows(landed: DataFrame, tables: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """The rows of each table of parsed multi-table pages."""
    return {name: landed.select(F.inline(F.col(f"data.{name}"))) for name in tables}


def read_tables(
    spark: SparkSession,
    paths,
    tables: dict[str, T.StructType],
    multi_line: bool = False,
    at_once: bool = True,
) -> dict[str, DataFrame]:
    """One DataFrame per table name of multi-table pages; an unreadable page raises an error.

    The pages are parsed and checked here and kept for all tables. With `at_once` off nothing is
    written: whoever reads a table parses the pages, and stops at one that cannot be read, which
    is cheaper where one table is read, and once.
    """
    if not at_once:
        paths = [paths] if isinstance(paths, str) else list(paths)
        bodies = spark.read.text(paths, wholetext=multi_line)
        return table_rows(_readable(bodies, schemas.table_envelope(tables)), tables)
    found, rejects = split_tables(spark, paths, tables, multi_line)
    bad = rejects.first()
    if bad is not None:
        raise ValueError(f"unreadable page: {(bad['value'] or '')[:200]}")
    return found


def merge_tables(payloads: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Table-wise union of payloads, over all table names that occur."""
    names = list(dict.fromkeys(name for payload in payloads for name in payload))
    return {
        name: reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True),
            [payload[name] for payload in payloads if name in payload],
        )
        for name in names
    }
