"""Periods, schema conforming, catalog and keyword queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import conform, keywords, periods
from tidemark.operators import catalog, paging, postings
from tidemark.plans import driver_tables as tables
from tidemark.plans.ordering import with_position
from tidemark.plans.registry import query
from tidemark.session import written_once
from tidemark.sources.tables import read_table
from tidemark.store import ItemDictionary

# Format name -> (text of a date column, SQL text, SQL period date).
_QUARTER_END = "last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)"


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _formatted(pattern):
    return lambda d: F.date_format(d, pattern)


def _monday_week(d):
    """Two-digit number of the Monday week, 0 before the first Monday."""
    week = F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7)
    return F.lpad(week.cast("string"), 2, "0")


PERIOD_FORMATS = {
    "month": (_formatted("yyyy-MM"), "strftime(o_orderdate, '%Y-%m')", "last_day(o_orderdate)"),
    "month_slash": (
        _formatted("yyyy/MM"),
        "strftime(o_orderdate, '%Y/%m')",
        "last_day(o_orderdate)",
    ),
    "quarter": (
        lambda d: _text(F.year(d), "-Q", F.quarter(d)),
        "year(o_orderdate) || '-Q' || quarter(o_orderdate)",
        _QUARTER_END,
    ),
    "quarter_compact": (
        lambda d: _text(F.year(d), "Q", F.quarter(d)),
        "year(o_orderdate) || 'Q' || quarter(o_orderdate)",
        _QUARTER_END,
    ),
    "quarter_year": (
        lambda d: _text("Q", F.quarter(d), " ", F.year(d)),
        "'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate)",
        _QUARTER_END,
    ),
    "year": (
        _formatted("yyyy"),
        "strftime(o_orderdate, '%Y')",
        "make_date(year(o_orderdate), 12, 31)",
    ),
    "month_name": (
        _formatted("MMMM yyyy"),
        "strftime(o_orderdate, '%B %Y')",
        "last_day(o_orderdate)",
    ),
    "month_short_name": (
        _formatted("MMM yyyy"),
        "strftime(o_orderdate, '%b %Y')",
        "last_day(o_orderdate)",
    ),
    "year_m_month": (
        lambda d: _text(F.year(d), "-M", F.month(d)),
        "year(o_orderdate) || '-M' || month(o_orderdate)",
        "last_day(o_orderdate)",
    ),
    "year_month_compact": (
        _formatted("yyyy'M'MM"),
        "strftime(o_orderdate, '%YM%m')",
        "last_day(o_orderdate)",
    ),
    "week": (
        lambda d: _text(F.year(d), "-W", _monday_week(d)),
        "strftime(o_orderdate, '%Y-W%W')",
        "(date_trunc('week', o_orderdate) + INTERVAL 5 DAY)::DATE",
    ),
    "half": (
        lambda d: _text(F.year(d), "-S", F.ceil(F.month(d) / 6).cast("string")),
        "year(o_orderdate) || '-S' || CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END",
        """CASE WHEN month(o_orderdate) <= 6 THEN make_date(year(o_orderdate), 6, 30)
                ELSE make_date(year(o_orderdate), 12, 31) END""",
    ),
    "bimonth": (
        lambda d: _text(F.year(d), "-B", F.ceil(F.month(d) / 2).cast("string")),
        "year(o_orderdate) || '-B' || ceil(month(o_orderdate) / 2)::INT",
        "make_date(year(o_orderdate), (ceil(month(o_orderdate) / 2)::INT * 2 - 1)::INT, 1)",
    ),
    "full_date_slash": (
        _formatted("yyyy/MM/dd"),
        "strftime(o_orderdate, '%Y/%m/%d')",
        "o_orderdate::DATE",
    ),
    "full_date_dot": (
        _formatted("yyyy.MM.dd"),
        "strftime(o_orderdate, '%Y.%m.%d')",
        "o_orderdate::DATE",
    ),
    "full_date_compact": (
        _formatted("yyyyMMdd"),
        "strftime(o_orderdate, '%Y%m%d')",
        "o_orderdate::DATE",
    ),
    "full_date_named": (
        _formatted("MMM d, yyyy"),
        "strftime(o_orderdate, '%b %-d, %Y')",
        "o_orderdate::DATE",
    ),
    "month_blanks": (
        lambda d: _text("  ", F.date_format(d, "yyyy-MM"), " "),
        "'  ' || strftime(o_orderdate, '%Y-%m') || ' '",
        "last_day(o_orderdate)",
    ),
    "full_date": (
        _formatted("yyyy-MM-dd"),
        "strftime(o_orderdate, '%Y-%m-%d')",
        "o_orderdate::DATE",
    ),
    "short_date": (_formatted("yyMMdd"), "strftime(o_orderdate, '%y%m%d')", "o_orderdate::DATE"),
}

# One column mixing frequencies, chosen by priority; the last one is unreadable.
MIXED = {
    "1-URGENT": "week",
    "2-HIGH": "bimonth",
    "3-MEDIUM": "quarter",
    "4-NOT SPECIFIED": "month",
}


def _mixed_text(d):
    text = _text("FY", F.year(d))
    for priority, name in MIXED.items():
        chosen = PERIOD_FORMATS[name][0](d)
        text = F.when(F.col("o_orderpriority") == priority, chosen).otherwise(text)
    return text


def _mixed_sql(part, last):
    branches = " ".join(
        f"WHEN '{priority}' THEN {part(PERIOD_FORMATS[name])}" for priority, name in MIXED.items()
    )
    return f"CASE o_orderpriority {branches} ELSE {last} END"


def _period_query(text):
    def run(spark, folder):
        points = read_table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("uuid"), text(F.col("o_orderdate")).alias("original_period")
        )
        dated = periods.with_period(points)
        return dated.withColumn("period", F.col("period").cast("string"))

    return run


def _period_sql(text, date):
    return f"""SELECT o_orderkey AS uuid, {text} AS original_period,
                      ({date})::DATE::VARCHAR AS period FROM orders"""


for _name, (_builder, _sql_text, _sql_date) in PERIOD_FORMATS.items():
    query(f"period_{_name}", _period_sql(_sql_text, _sql_date))(_period_query(_builder))

query(
    "period_mixed",
    _period_sql(
        _mixed_sql(lambda f: f[1], "'FY' || year(o_orderdate)"),
        _mixed_sql(lambda f: f"({f[2]})::DATE", "NULL"),
    ),
)(_period_query(_mixed_text))


@query(
    "period_rejects",
    """WITH t AS (SELECT CASE o_custkey % 3 WHEN 0 THEN 'FY' || year(o_orderdate)
                    WHEN 1 THEN month(o_orderdate) || '/' || day(o_orderdate) || '?' ELSE '-' END AS p
                  FROM orders WHERE o_orderpriority = '5-LOW')
       SELECT regexp_replace(regexp_replace(p, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') AS shape,
              count(*) AS n_rows FROM t GROUP BY 1""",
)
def period_rejects(spark, folder):
    """Strings of no known format, in several shapes, among others that are dates."""
    day = F.col("o_orderdate")
    odd = (
        F.when(F.col("o_custkey") % 3 == 0, _text("FY", F.year(day)))
        .when(F.col("o_custkey") % 3 == 1, _text(F.month(day), "/", F.dayofmonth(day), "?"))
        .otherwise("-")
    )
    text = F.when(F.col("o_orderpriority") == "5-LOW", odd).otherwise(_mixed_text(day))
    points = read_table(spark, folder, "orders").select(text.alias("original_period"))
    return periods.rejected_periods(points)


def series(spark, folder):
    """Event types as series, their months as periods."""
    return read_table(spark, folder, "events").select(
        F.col("event_type").alias("payload_id"),
        F.date_format("ts", "yyyy-'M'MM").alias("original_period"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("original_value"),
        "value",
        "event_id",
    )


@query(
    "series_payload",
    """SELECT event_id, event_type AS payload_id, strftime(ts, '%Y-M%m') AS original_period,
              value::DECIMAL(12, 2)::VARCHAR AS original_value, value,
              last_day(ts)::VARCHAR AS period
       FROM events WHERE event_type = 'purchase'""",
)
def series_payload(spark, folder):
    points = catalog.series_payload(series(spark, folder), "purchase")
    return points.withColumn("period", F.col("period").cast("string"))


# Casting and conforming: line items written as raw text, then read back.


def raw_lines(spark, folder):
    """Line items as text with the null tokens the sources use."""
    flag = F.col("l_returnflag")
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("uuid"),
        F.col("l_linenumber").alias("line"),
        F.when(flag == "N", "NA")
        .when(flag == "R", "")
        .when(F.col("l_linenumber") == 6, "six")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("item_value"),
        F.when(flag == "N", "NA").otherwise(flag).alias("flag"),
        F.when(F.col("l_linestatus") == "F", F.col("l_suppkey").cast("string")).otherwise(
            F.concat(F.lit("x"), F.col("l_suppkey"))
        ).alias("gvk"),
        F.when(F.col("l_linenumber") == 7, "n/a")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("filing_date"),
    )


CASTS = {"item_value": "double", "gvk": "bigint", "filing_date": "timestamp_ntz"}


@query(
    "clean_cast",
    """SELECT l_orderkey AS uuid, l_linenumber AS line,
              CASE WHEN l_returnflag = 'A' AND l_linenumber <> 6 THEN l_quantity END AS item_value,
              nullif(l_returnflag, 'N') AS flag,
              CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS gvk,
              CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS filing_date
       FROM lineitem""",
)
def clean_cast(spark, folder):
    return conform.typed_columns(raw_lines(spark, folder), CASTS)


@query(
    "cast_failures",
    """SELECT 'item_value' AS column_name, count(*) AS n_failed FROM lineitem
       WHERE l_returnflag = 'A' AND l_linenumber = 6
       UNION ALL SELECT 'gvk', count(*) FROM lineitem WHERE l_linestatus <> 'F'
       UNION ALL SELECT 'filing_date', count(*) FROM lineitem WHERE l_linenumber = 7""",
)
def cast_failures(spark, folder):
    return conform.cast_failures(raw_lines(spark, folder), CASTS)


HOLDING_SCHEMA = schemas.struct(
    uuid=schemas.LONG,
    cusip=schemas.STRING,
    other_manager=schemas.INTS,
    put_call=schemas.STRING,
    ssh_prnamt=schemas.LONG,
    line=schemas.INT,
)


@query(
    "conform_union",
    """SELECT l_orderkey AS uuid, l_partkey::VARCHAR AS cusip,
              CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN NULL
                   WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN l_linenumber::VARCHAR
                   ELSE l_linenumber || ',' || l_suppkey END AS other_manager,
              CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'Put' END AS put_call,
              CASE WHEN l_linestatus <> 'F' OR l_linenumber <> 3 THEN l_quantity::BIGINT END
                AS ssh_prnamt,
              CASE WHEN l_linestatus <> 'F' OR l_linenumber <> 4 THEN l_linenumber END::INT AS line
       FROM lineitem""",
)
def conform_union(spark, folder):
    """Historical text rows and live typed rows of one table, in one schema."""
    united = conform.conform_union(holding_vintages(spark, folder), HOLDING_SCHEMA)
    managers = F.col("other_manager").cast("array<string>")
    return united.withColumn("other_manager", F.array_join(managers, ","))


@query(
    "conform_failures",
    """SELECT 'uuid' AS column_name, 0::BIGINT AS n_failed
       UNION ALL SELECT 'cusip', 0 UNION ALL SELECT 'other_manager', 0 UNION ALL SELECT 'put_call', 0
       UNION ALL SELECT 'ssh_prnamt', count(*) FROM lineitem WHERE l_linestatus = 'F' AND l_linenumber = 3
       UNION ALL SELECT 'line', count(*) FROM lineitem WHERE l_linestatus = 'F' AND l_linenumber = 4""",
)
def conform_failures(spark, folder):
    """Fractions and words where whole numbers are declared: NULL, and counted."""
    return conform.conform_failures(holding_vintages(spark, folder)[0], HOLDING_SCHEMA)


def holding_vintages(spark, folder):
    """Historical rows as text, some unreadable, and live rows with types."""
    lines = read_table(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    historical = lines.where("l_linestatus = 'F'").select(
        F.col("l_orderkey").cast("string").alias("uuid"),
        F.col("l_partkey").cast("string").alias("cusip"),
        F.when(flag == "N", "")
        .when(flag == "R", _text("(", F.col("l_linenumber"), ",)"))
        .otherwise(_text("(", F.col("l_linenumber"), ", ", F.col("l_suppkey"), ")"))
        .alias("other_manager"),
        F.when(flag == "A", "Put").otherwise("").alias("put_call"),
        F.when(F.col("l_linenumber") == 3, F.concat(F.col("l_quantity").cast("int"), F.lit(".25")))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("ssh_prnamt"),
        F.when(F.col("l_linenumber") == 4, "four")
        .otherwise(F.concat("l_linenumber", F.lit(".0")))
        .alias("line"),
    )
    live = lines.where("l_linestatus <> 'F'").select(
        F.col("l_orderkey").alias("uuid"),
        F.col("l_partkey").cast("string").alias("cusip"),
        F.array("l_linenumber", F.col("l_suppkey").cast("int")).alias("other_manager"),
        F.col("l_quantity").cast("int").alias("ssh_prnamt"),
        F.col("l_linenumber").alias("line"),
    )
    return [historical, live]


@query(
    "iso_conformance",
    """WITH t AS (SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS known,
                    CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
                      WHEN 'error' THEN NULL WHEN 'click' THEN strftime(ts, '%Y-13-%dT%H:%M:%S')
                      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS mixed FROM events),
            v AS (SELECT 'known' AS column_name, known AS p FROM t UNION ALL SELECT 'mixed', mixed FROM t)
       SELECT column_name, count(*) FILTER (bad) = 0 AS conforms, count(*) FILTER (bad) AS n_violations
       FROM (SELECT column_name, p IS NOT NULL AND NOT (regexp_matches(p, '^[0-9]{4}-[0-9]{2}-[0-9]{2}T')
                      AND TRY_CAST(p AS TIMESTAMP) IS NOT NULL) AS bad FROM v) GROUP BY 1""",
)
def iso_conformance(spark, folder):
    """A column of date-times, and one with days, gaps and months beyond December among them."""
    whole, kind = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_type")
    mixed = (
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "click", F.date_format("ts", "yyyy-'13'-dd'T'HH:mm:ss"))
        .when(kind != "error", whole)
    )
    texts = read_table(spark, folder, "events").select(whole.alias("known"), mixed.alias("mixed"))
    return conform.iso_conformance(texts, "known", "mixed")


# Catalog.

SEARCH = dict(text="ring", commodity=["ECONOMY", "SMALL"], business_category="")
_SEARCH_SQL = """p_type IN ('ECONOMY', 'SMALL')
  AND lower(concat_ws(' ', p_name, p_type, p_brand, p_size::VARCHAR)) LIKE '%ring%'"""
_CATALOG_SQL = """p_partkey AS payload_id, p_name AS name, p_type AS commodity,
  p_brand AS business_category, p_size::VARCHAR AS country,
  regexp_extract(p_name, '(\\S+)$', 1) AS frequency"""


@query("catalog_search", f"SELECT {_CATALOG_SQL} FROM part WHERE {_SEARCH_SQL}")
def catalog_search(spark, folder):
    return catalog.search(tables.catalog(spark, folder), **SEARCH)


@query("catalog_count", f"SELECT count(*) AS total_count FROM part WHERE {_SEARCH_SQL}")
def catalog_count(spark, folder):
    return catalog.search_count(tables.catalog(spark, folder), **SEARCH)


def _facet_query(facet):
    def run(spark, folder):
        return catalog.facet_values(tables.catalog(spark, folder), facet)

    return run


for _facet, _source in {
    "COMMODITIES": "p_type",
    "BUSINESS-CATEGORIES": "p_brand",
    "COUNTRIES": "p_size::VARCHAR",
    "FREQUENCIES": "regexp_extract(p_name, '(\\S+)$', 1)",
}.items():
    query(
        f"facet_values_{_facet.lower().replace('-', '_')}",
        f'SELECT DISTINCT {_source} AS "{_facet}" FROM part',
    )(_facet_query(_facet))

_PAGE_KEY = ["name", "payload_id"]


_PLACED_SQL = f"SELECT {_CATALOG_SQL}, row_number() OVER (ORDER BY p_name, p_partkey) AS position FROM part"


@query("search_page", f"{_PLACED_SQL} ORDER BY position LIMIT 1000")
def search_page(spark, folder):
    return with_position(catalog.page_after(tables.catalog(spark, folder), _PAGE_KEY))


@query(
    "search_next_page",
    f"""{_PLACED_SQL} WHERE p_name > 'green' OR (p_name = 'green' AND p_partkey > 5)
        ORDER BY position LIMIT 1000""",
)
def search_next_page(spark, folder):
    rows = tables.catalog(spark, folder)
    return with_position(catalog.page_after(rows, _PAGE_KEY, last=("green", 5)))


@query(
    "search_null_page",
    """SELECT p_partkey AS payload_id, nullif(p_type, 'ECONOMY') AS commodity,
              row_number() OVER (ORDER BY nullif(p_type, 'ECONOMY') NULLS FIRST, p_partkey) AS position
       FROM part WHERE p_type <> 'ECONOMY' OR p_partkey > 90 ORDER BY position LIMIT 700""",
)
def search_null_page(spark, folder):
    """The page behind one that ended among rows without the leading key."""
    rows = tables.catalog(spark, folder).select(
        "payload_id", F.nullif("commodity", F.lit("ECONOMY")).alias("commodity")
    )
    key = ["commodity", "payload_id"]
    return with_position(catalog.page_after(rows, key, last=(None, 90), size=700))


@query(
    "search_all_pages",
    """SELECT p_partkey AS payload_id,
              (row_number() OVER (ORDER BY nullif(p_type, 'ECONOMY') NULLS FIRST, p_partkey) - 1) // 150
                AS page
       FROM part""",
)
def search_all_pages(spark, folder):
    """Every page of a catalog in which some rows lack the leading key, numbered in one job."""
    rows = tables.catalog(spark, folder).select(
        "payload_id", F.nullif("commodity", F.lit("ECONOMY")).alias("commodity")
    )
    found = paging.numbered_pages(rows, ["commodity", "payload_id"], 150)
    return found.select("payload_id", (F.col("page") - 1).alias("page"))


@query(
    "deep_page",
    """SELECT l_orderkey AS uuid, l_linenumber AS line, l_partkey AS cusip, position FROM (
         SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey,
                                      l_quantity, l_extendedprice) AS position,
                count(*) OVER () AS n FROM lineitem)
       WHERE position > (n * 9 // 10 // 500) * 500 AND position <= (n * 9 // 10 // 500) * 500 + 500""",
)
def deep_page(spark, folder):
    """A page of 500 at nine tenths of a table, read from the key ranges that hold it."""
    rows = read_table(spark, folder, "lineitem")
    key = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    ranges = paging.key_ranges(rows, key)
    number = ranges.agg(F.sum("n")).first()[0] * 9 // 10 // 500
    page = paging.page_by_number(rows, key, number + 1, 500, ranges)
    page = page.select(
        F.col("l_orderkey").alias("uuid"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("cusip"),
        *key,
    )
    return _from(page.orderBy(*key).drop(*key), number * 500)


@query("offset_page", f"{_PLACED_SQL} ORDER BY position LIMIT 500 OFFSET 750")
def offset_page(spark, folder):
    return _from(catalog.offset_page(tables.catalog(spark, folder), _PAGE_KEY, 750, 500), 750)


@query("numbered_page", f"{_PLACED_SQL} ORDER BY position LIMIT 300 OFFSET 600")
def numbered_page(spark, folder):
    return _from(catalog.numbered_page(tables.catalog(spark, folder), _PAGE_KEY, 3, 300), 600)


def _from(page, offset):
    placed = with_position(page)
    return placed.withColumn("position", F.col("position") + offset)


# Item dictionary and keyword search.


def dictionary(spark, folder) -> ItemDictionary:
    """Parts as items, their names as descriptions."""
    return ItemDictionary(
        read_table(spark, folder, "part").select(
            F.col("p_partkey").alias("item"), F.col("p_name").alias("description")
        )
    )


@query("item_mapping", "SELECT p_partkey AS item, p_name AS description FROM part")
def item_mapping(spark, folder):
    return dictionary(spark, folder).get_mapping()


def _tokens_sql(text):
    return f"[t for t in regexp_split_to_array(lower({text}), '[\\s-]+') if t <> '']"


@query(
    "keyword_search",
    f"""SELECT item, description, score, n_tokens,
               row_number() OVER (ORDER BY score DESC, n_tokens, item) AS position FROM (
          SELECT p_partkey AS item, p_name AS description,
                 len(list_intersect({_tokens_sql('p_name')}, ['blue', 'red', 'ring'])) AS score,
                 len({_tokens_sql('p_name')}) AS n_tokens FROM part)
        WHERE score > 0""",
)
def keyword_search(spark, folder):
    found = keywords.search_items(dictionary(spark, folder).get_mapping(), "Red-Ring blue ring")
    return with_position(found)


@query(
    "keyword_search_documents",
    f"""SELECT doc_id, score, n_tokens FROM (
          SELECT doc_id, len(list_intersect({_tokens_sql('text')}, ['and', 'les', 'license', 'the']))
                 AS score, len({_tokens_sql('text')}) AS n_tokens FROM documents)
        WHERE score > 0""",
)
def keyword_search_documents(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    found = keywords.keyword_matches(documents, "text", ["the license", "and les"])
    return found.select("doc_id", "score", "n_tokens")


@query(
    "keyword_postings",
    f"""SELECT doc_id, score, n_tokens FROM (
          SELECT doc_id, len(list_intersect({_tokens_sql('text')}, ['and', 'les', 'license', 'the']))
                 AS score, len({_tokens_sql('text')}) AS n_tokens FROM documents)
        WHERE score > 0""",
)
def keyword_postings(spark, folder):
    """The same search, read from stored postings of its tokens."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    path = written_once(
        spark,
        "keyword-postings",
        folder,
        lambda path: postings.write_keywords(documents, ["doc_id"], "text", path),
    )
    return postings.search_keywords(spark, path, ["doc_id"], ["the license", "and les"])


@query(
    "catalog_substring",
    f"""SELECT {_CATALOG_SQL} FROM part
        WHERE lower(concat_ws(' ', p_name, p_type, p_brand, p_size::VARCHAR)) LIKE '%ue ri%'""",
)
def catalog_substring(spark, folder):
    """Series whose columns hold a text, from stored three-letter postings."""
    rows = tables.catalog(spark, folder)
    path = written_once(
        spark, "grams", folder, lambda path: postings.write_grams(rows, ["payload_id"], path)
    )
    return postings.search_substring(rows, path, ["payload_id"], "UE ri")
