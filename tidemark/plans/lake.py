"""From landed pages to stored tables of declared schema, and the queries that read them there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import payloads
from tidemark.plans import driver_tables as tables
from tidemark.plans.landing import paged_by_row
from tidemark.plans.registry import query
from tidemark.session import shared_folder, stored, written_once
from tidemark.sources import files, pages
from tidemark.sources.tables import read_filings, read_table, store_vintages, with_filing_day
from tidemark.store import FilingStore

# Priorities of the driver table -> forms of two families.
FORMS = {
    "1-URGENT": "4",
    "2-HIGH": "3",
    "3-MEDIUM": "13F-HR",
    "4-NOT SPECIFIED": "13F-HR/A",
    "5-LOW": "5/A",
}
FORM_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN '{f}'" for p, f in FORMS.items()) + " END"
WINDOW = dict(
    start_datetime="1997-02-10T00:00:00+00:00",
    end_datetime="1999-11-05T00:00:00+00:00",
    date_mode="publication_date",
)
_WINDOW_SQL = "o_orderdate >= TIMESTAMP '1997-02-10' AND o_orderdate < TIMESTAMP '1999-11-05'"


def form() -> Column:
    pairs = [F.lit(x) for pair in FORMS.items() for x in pair]
    return F.element_at(F.create_map(*pairs), F.col("form_type"))


def as_text(schema: T.StructType) -> T.StructType:
    """The historical vintage of a table: all values are texts."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def header_rows(spark, folder) -> DataFrame:
    instant = F.date_format("filing_date", "yyyy-MM-dd'T'HH:mm:ss")
    return tables.filings(spark, folder).select(
        F.col("uuid").cast("string").alias("uuid"),
        "cik",
        F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"),
        form().alias("form_type"),
        F.concat(F.lit("edgar/"), "uuid").alias("edgar_path"),
        F.concat(F.lit(" Filer "), "cik", F.lit(" ")).alias("company"),
        instant.alias("acceptance_datetime"),
        F.lit("").alias("period_of_report"),
        instant.alias("header_availability_timestamp"),
        "status",
    )


def land(rows: DataFrame, path: str, table: str | None = None) -> None:
    link = F.lit("https://filings.example.org/lake")
    files.write_page_texts(paged_by_row(rows, link, table), path)


def family_rows(rows: DataFrame, family: str) -> DataFrame:
    return rows.where(F.col("form_type").isin(schemas.FORM_FAMILIES[family]))


def store_headers(spark, folder, path) -> None:
    """Pages of both vintages landed, read back, conformed and stored by family and month; a filer
    number of the historical vintage is a decimal text, and one of a hundred is a word."""
    rows = header_rows(spark, folder)
    words = F.when(F.col("cik") % 100 == 7, "seven").otherwise(F.concat("cik", F.lit(".0")))
    for family in ("form4", "form13"):
        mine = family_rows(rows, family)
        landing = shared_folder(spark, f"{family}-pages")
        land(mine.where("status = 'F'").withColumn("cik", words).drop("status"), f"{landing}/old")
        land(mine.where("status <> 'F'").drop("status", "period_of_report"), f"{landing}/live")
        vintages = [
            pages.page_rows(pages.read_pages(spark, f"{landing}/{name}", schema))
            for name, schema in (("old", as_text(schemas.HEADERS)), ("live", schemas.HEADERS))
        ]
        lost = store_vintages(vintages, schemas.HEADERS, f"{path}/headers", family)
        lost.withColumn("family", F.lit(family)).write.mode("append").parquet(f"{path}/lost")


def headers_lake(spark, folder) -> str:
    return written_once(
        spark, "headers-lake", folder, lambda path: store_headers(spark, folder, path)
    )


@query(
    "stored_headers",
    f"""SELECT o_orderkey::VARCHAR AS uuid,
               CASE WHEN o_orderstatus <> 'F' OR o_custkey % 100 <> 7 THEN o_custkey END AS cik,
               o_orderdate::DATE AS filing_date, {FORM_SQL} AS form_type,
               'Filer ' || o_custkey AS company, o_orderdate AS accepted
        FROM orders WHERE {FORM_SQL} IN ('3', '4') AND {_WINDOW_SQL}""",
)
def stored_headers(spark, folder):
    """Headers of two forms in a window, from pages over conforming to the stored table."""
    store = FilingStore.open(spark, headers_lake(spark, folder))
    found = store.get_form_headers(form_type=["3", "4"], ordered=False, **WINDOW)
    accepted = F.col("acceptance_datetime").cast("timestamp_ntz").alias("accepted")
    return found.select("uuid", "cik", "filing_date", "form_type", "company", accepted)


@query(
    "stored_failures",
    f"""SELECT CASE WHEN {FORM_SQL} LIKE '13F%' THEN 'form13' ELSE 'form4' END AS family,
               0 AS vintage, 'cik' AS column_name, count(*) AS n_failed
        FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 100 = 7 GROUP BY 1""",
)
def stored_failures(spark, folder):
    """What conforming could not read while the headers were stored."""
    lost = spark.read.parquet(f"{headers_lake(spark, folder)}/lost")
    return lost.select("family", "vintage", "column_name", "n_failed")


@query(
    "point_lookup",
    f"""SELECT o_orderkey::VARCHAR AS uuid, o_orderdate::DATE AS filing_date, {FORM_SQL} AS form_type
        FROM orders WHERE o_orderkey IN (17, 4242, 999999999)""",
)
def point_lookup(spark, folder):
    """Single filings by uuid from the stored table."""
    headers = read_filings(spark, f"{headers_lake(spark, folder)}/headers", schemas.HEADERS)
    found = payloads.document_by_uuid(headers, ["17", "4242", "999999999"])
    return found.select("uuid", "filing_date", "form_type")


def store_holdings(spark, folder, path) -> None:
    """Metadata, headers and lines of the holdings reports; lines carry the day of their report."""
    reports = header_rows(spark, folder).where("form_type like '13F%'").withColumn(
        "form_availability_timestamp", F.col("header_availability_timestamp")
    )
    lines = tables.holding_lines(spark, folder).select(
        F.col("uuid").cast("string").alias("uuid"),
        F.col("cusip").cast("string").alias("cusip"),
        F.concat(F.col("quantity").cast("int"), F.lit(".0")).alias("ssh_prnamt"),
        F.nullif("put_call", F.lit("N")).alias("put_call"),
        F.concat(F.lit("("), "line", F.lit(",)")).alias("other_manager"),
    )
    dated = stored(with_filing_day(lines, reports))
    for name, schema in schemas.HOLDINGS.items():
        rows = dated if name == "information_table" else reports
        kept = [f.name for f in schema if f.name in rows.columns]
        landing = shared_folder(spark, f"{name}-pages")
        land(rows.select(*kept), landing, name)
        landed = pages.read_tables(spark, landing, {name: as_text(schema)}, at_once=False)[name]
        store_vintages([landed], schema, f"{path}/holdings/{name}", "form13")


def holdings_lake(spark, folder) -> str:
    return written_once(
        spark, "holdings-lake", folder, lambda path: store_holdings(spark, folder, path)
    )


@query(
    "stored_holdings",
    f"""SELECT l_orderkey::VARCHAR AS uuid, o_orderdate::DATE AS filing_date, l_partkey::VARCHAR AS cusip,
               l_quantity::BIGINT AS ssh_prnamt, nullif(l_returnflag, 'N') AS put_call,
               l_linenumber AS manager
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE {FORM_SQL} LIKE '13F%' AND {_WINDOW_SQL} AND l_partkey IN (3, 5, 8, 13, 21, 34, 55, 89)""",
)
def stored_holdings(spark, folder):
    """Holdings of given securities in a window, read from the stored tables."""
    store = FilingStore.open(spark, holdings_lake(spark, folder))
    wanted = [str(n) for n in (3, 5, 8, 13, 21, 34, 55, 89)]
    lines = store.get_form13_payload(cusip=wanted, ordered=False, **WINDOW)["information_table"]
    manager = F.element_at("other_manager", 1).alias("manager")
    return lines.select("uuid", "filing_date", "cusip", "ssh_prnamt", "put_call", manager)


# Insider forms: six tables of one payload.


def insider_tables(spark, folder) -> dict[str, DataFrame]:
    """Lines by their flag as the two securities tables; no filing has a reporting owner."""
    filings = tables.filings(spark, folder).withColumn("form_type", form())
    lines = tables.holding_lines(spark, folder).select(
        "uuid", "line", "put_call", F.array(F.concat(F.lit("F"), "line")).alias("footnote_ids")
    )
    return {
        "metadata": filings,
        "derivative_table": lines.where("put_call = 'A'"),
        "non_derivative_table": lines.where("put_call = 'N'"),
        "footnotes": lines.select(
            "uuid", F.concat(F.lit("F"), "line").alias("footnote_id"), F.col("put_call").alias("footnote")
        ),
        "general_info": filings.select("uuid", "status", "total"),
        "reporting_owner_info": lines.where("put_call = 'owner'"),
    }


_INSIDER_SQL = f"{FORM_SQL} IN ('3', '4') AND {_WINDOW_SQL}"


@query(
    "insider_six_tables",
    f"""WITH f AS (SELECT o_orderkey AS uuid FROM orders WHERE {_INSIDER_SQL}),
             l AS (SELECT l_orderkey AS uuid, l_returnflag AS flag FROM lineitem
                   WHERE l_orderkey IN (SELECT uuid FROM f)),
             t AS (SELECT 'metadata' AS name, uuid FROM f UNION ALL SELECT 'general_info', uuid FROM f
                   UNION ALL SELECT 'derivative_table', uuid FROM l WHERE flag = 'A'
                   UNION ALL SELECT 'non_derivative_table', uuid FROM l WHERE flag = 'N'
                   UNION ALL SELECT 'footnotes', uuid FROM l
                   UNION ALL SELECT 'reporting_owner_info', uuid FROM l WHERE flag = 'owner')
        SELECT n.name, uuid, count(uuid) AS n_rows
        FROM (VALUES {", ".join(f"('{n}')" for n in schemas.INSIDER_TABLES)}) n(name)
        LEFT JOIN t USING (name) GROUP BY 1, 2""",
)
def insider_six_tables(spark, folder):
    """Rows per filing in each of the six tables; a table without rows is there all the same."""
    store = FilingStore(insider=insider_tables(spark, folder))
    found = store.get_form4_payload(keep_parent=True, **WINDOW)
    found = {
        name: payloads.children_of(found["metadata"].where("form_type in ('3', '4')"), rows)
        for name, rows in found.items()
    }
    names = spark.createDataFrame([(n,) for n in found], "name string")
    rows = [df.select(F.lit(name).alias("name"), "uuid") for name, df in found.items()]
    union = rows[0]
    for more in rows[1:]:
        union = union.unionByName(more)
    counts = union.groupBy("name", "uuid").agg(F.count("uuid").alias("n_rows"))
    return names.join(counts, "name", "left").select(
        "name", "uuid", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query(
    "insider_footnotes",
    f"""SELECT l_orderkey AS uuid, l_linenumber AS line, string_agg(DISTINCT n.l_returnflag, '; '
                 ORDER BY n.l_returnflag) AS notes
        FROM lineitem r JOIN lineitem n USING (l_orderkey, l_linenumber)
        WHERE r.l_returnflag = 'A' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE {_INSIDER_SQL})
        GROUP BY 1, 2""",
)
def insider_footnotes(spark, folder):
    """Lines of one table with the texts of their footnotes in another."""
    held = payloads.insider_payload(insider_tables(spark, folder), form_type=["3", "4"], **WINDOW)
    notes = payloads.resolve_footnotes(
        held["derivative_table"], held["footnotes"], ["uuid", "line"]
    )
    texts = F.array_sort(F.array_distinct("footnotes"))
    return notes.select("uuid", "line", F.array_join(texts, "; ").alias("notes"))


# Documents in their declared schema.


@query(
    "document_known",
    """SELECT event_id::VARCHAR AS uuid, user_id AS cik, (props->>'$.k')::BIGINT AS k FROM events
       WHERE ts >= TIMESTAMP '2024-01-05 21:11:20' AND ts < TIMESTAMP '2024-01-20 13:45:19'""",
)
def document_known(spark, folder):
    """Documents of the declared schema, by the instant they were known."""
    documents = read_table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("uuid"),
        F.col("user_id").alias("cik"),
        F.to_date("ts").alias("filing_date"),
        F.lit("10-K").alias("form_type"),
        F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts")
        .cast("timestamp")
        .alias("form_availability_timestamp"),
        F.lit(False).alias("is_real_time"),
        F.parse_json("props").alias("data"),
    )
    documents = documents.select(*schemas.DOCUMENTS.names)
    store = FilingStore(documents=documents)
    found = store.get_form10_payload(
        start_datetime="2024-01-05T21:11:20+00:00",
        end_datetime="2024-01-20T08:45:19-05:00",
        date_mode="knowledge_date",
    )
    return found.select("uuid", "cik", payloads.document_path("data", "$.k", "bigint").alias("k"))


def store_items(spark, folder, path) -> None:
    """Pages of 8-K items of both vintages landed, read back, conformed and stored; in the historical
    one values are texts, `NA` among them, and one of a hundred is a word."""
    events = read_table(spark, folder, "events")
    instant = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    number = F.col("event_id") % 100
    rows = events.select(
        F.col("event_id").cast("string").alias("form_uuid"),
        instant.alias("form_publication_timestamp"),
        F.date_format("ts", "yyyy-MM-dd").alias("filing_date"),
        F.col("user_id").alias("cik"),
        F.when(number < 30, "NA").otherwise(F.concat(F.lit(" T"), number, F.lit(" "))).alias("ticker"),
        F.col("event_type").alias("item_name"),
        F.col("value").alias("item_value"),
        number.alias("_number"),
    )
    token = F.when(F.col("_number") == 7, "many").when(F.col("_number") < 20, "NA")
    text = F.coalesce(token, F.col("item_value").cast("string"))
    old = rows.where("_number % 2 = 1").withColumn("item_value", text)
    old = old.withColumn("cik", F.when(F.col("_number") == 9, "NA").otherwise(F.concat("cik", F.lit(".0"))))
    landing = shared_folder(spark, "item-pages")
    land(old.drop("_number"), f"{landing}/old")
    land(rows.where("_number % 2 = 0").drop("_number"), f"{landing}/live")
    vintages = [
        pages.page_rows(pages.read_pages(spark, f"{landing}/{name}", schema))
        for name, schema in (("old", as_text(schemas.FORM8_ITEMS)), ("live", schemas.FORM8_ITEMS))
    ]
    lost = store_vintages(vintages, schemas.FORM8_ITEMS, f"{path}/items", "form8")
    lost.write.mode("append").parquet(f"{path}/lost")


def items_lake(spark, folder) -> str:
    return written_once(spark, "items-lake", folder, lambda path: store_items(spark, folder, path))


@query(
    "stored_items",
    """SELECT event_id::VARCHAR AS form_uuid, CASE WHEN event_id % 100 <> 9 THEN user_id END AS cik,
              CASE WHEN event_id % 100 >= 30 THEN 'T' || event_id % 100 END AS ticker,
              event_type AS item_name,
              CASE WHEN event_id % 2 = 0 OR (event_id % 100 >= 20) THEN value END AS item_value,
              ts::DATE AS filing_date
       FROM events""",
)
def stored_items(spark, folder):
    """8-K items from pages over conforming to the stored table: `NA` is no value in any column."""
    items = read_filings(spark, f"{items_lake(spark, folder)}/items", schemas.FORM8_ITEMS)
    return items.select("form_uuid", "cik", "ticker", "item_name", "item_value", "filing_date")


@query(
    "stored_item_failures",
    """SELECT 0 AS vintage, 'item_value' AS column_name, count(*) AS n_failed FROM events
       WHERE event_id % 100 = 7""",
)
def stored_item_failures(spark, folder):
    """Only words fail to read as numbers; `NA` does not count as unreadable."""
    lost = spark.read.parquet(f"{items_lake(spark, folder)}/lost")
    return lost.select("vintage", "column_name", "n_failed")
