"""Documents, insider forms and the series catalog: landed, conformed, stored, and read back there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import payloads
from tidemark.plans import driver_tables as tables
from tidemark.plans.lake import (
    _WINDOW_SQL,
    FORM_SQL,
    WINDOW,
    as_text,
    family_rows,
    header_rows,
    land,
)
from tidemark.plans.registry import query
from tidemark.plans.series import series as series_points
from tidemark.session import shared_folder, stored, written_once
from tidemark.sources import pages
from tidemark.sources.tables import (
    read_table,
    store_vintages,
    with_filing_day,
    write_catalog,
)
from tidemark.store import FilingStore, SeriesCatalog

# Documents: the historical vintage holds the body as a text.


def store_documents(spark, folder, path) -> None:
    """Pages of documents of both vintages landed, read back, conformed and stored; one body of a
    hundred of the historical vintage breaks off, and one is `NA`."""
    number = F.col("event_id") % 100
    rows = read_table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("uuid"),
        F.col("user_id").alias("cik"),
        F.date_format("ts", "yyyy-MM-dd").alias("filing_date"),
        F.when(number < 50, "10-K").otherwise("10-Q").alias("form_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("form_availability_timestamp"),
        (number % 2 == 0).alias("is_real_time"),
        F.col("props").alias("data"),
        number.alias("_number"),
    )
    broken = F.expr("left(data, octet_length(data) - 1)")
    text = F.when(F.col("_number") == 7, broken).when(F.col("_number") == 9, "NA")
    old = rows.where("_number % 2 = 1").withColumn("data", F.coalesce(text, "data"))
    live = rows.where("_number % 2 = 0").withColumn("data", F.parse_json("data"))
    landing = shared_folder(spark, "document-pages")
    land(old.withColumn("cik", F.concat("cik", F.lit(".0"))).drop("_number"), f"{landing}/old")
    land(live.drop("_number"), f"{landing}/live")
    vintages = [
        pages.page_rows(pages.read_pages(spark, f"{landing}/{name}", schema))
        for name, schema in (("old", as_text(schemas.DOCUMENTS)), ("live", schemas.DOCUMENTS))
    ]
    lost = store_vintages(vintages, schemas.DOCUMENTS, f"{path}/documents", "form10")
    lost.write.mode("append").parquet(f"{path}/lost")


def documents_lake(spark, folder) -> str:
    return written_once(
        spark, "documents-lake", folder, lambda path: store_documents(spark, folder, path)
    )


@query(
    "stored_documents",
    """SELECT event_id::VARCHAR AS uuid, user_id AS cik, ts::DATE AS filing_date,
              CASE WHEN event_id % 100 < 50 THEN '10-K' ELSE '10-Q' END AS form_type,
              CASE WHEN event_id % 100 NOT IN (7, 9) THEN (props->>'$.k')::BIGINT END AS k
       FROM events WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-05 21:11:20'
         AND date_trunc('second', ts) < TIMESTAMP '2024-01-20 13:45:19'""",
)
def stored_documents(spark, folder):
    """Documents known in a window, bodies of both vintages, from the stored table."""
    store = FilingStore.open(spark, documents_lake(spark, folder))
    found = store.get_form10_payload(
        start_datetime="2024-01-05T21:11:20+00:00",
        end_datetime="2024-01-20T08:45:19-05:00",
        date_mode="knowledge_date",
    )
    body = payloads.document_path("data", "$.k", "bigint").alias("k")
    return found.select("uuid", "cik", "filing_date", "form_type", body)


@query(
    "stored_document_failures",
    """SELECT 0 AS vintage, 'data' AS column_name, count(*) AS n_failed FROM events
       WHERE event_id % 100 = 7""",
)
def stored_document_failures(spark, folder):
    """Bodies that break off are counted; `NA` is no body at all."""
    lost = spark.read.parquet(f"{documents_lake(spark, folder)}/lost")
    return lost.select("vintage", "column_name", "n_failed")


# Insider forms: six stored tables, the historical vintage with its lists as texts.


def insider_rows(spark, folder) -> dict[str, DataFrame]:
    """Lines by their flag as the two securities tables; no filing has a reporting owner.

    Forms and lines are written once, as each of the tables goes through them several times.
    """
    forms = family_rows(header_rows(spark, folder), "form4")
    forms = stored(forms.withColumn("form_availability_timestamp", F.col("header_availability_timestamp")))
    lines = tables.holding_lines(spark, folder).select(
        F.col("uuid").cast("string").alias("uuid"),
        F.col("put_call").alias("flag"),
        F.concat(F.lit("F"), "line").alias("footnote_id"),
        F.concat(F.lit("Note "), "line").alias("footnote"),
    )
    lines = with_filing_day(lines, forms).join(forms.select("uuid", "status"), "uuid")
    lines = stored(lines).withColumn("footnote_ids", F.array("footnote_id", F.lit("F0")))
    return {
        "metadata": forms,
        "derivative_table": lines.where("flag = 'A'"),
        "non_derivative_table": lines.where("flag = 'N'"),
        "footnotes": lines,
        "general_info": forms,
        "reporting_owner_info": lines.where("flag = 'owner'"),
    }


def store_insider(spark, folder, path) -> None:
    """Each of the six tables landed in both vintages, read back, conformed and stored by month."""
    as_listed = F.concat(F.lit("['"), F.array_join("footnote_ids", "', '"), F.lit("']"))
    for name, rows in insider_rows(spark, folder).items():
        schema = schemas.INSIDER[name]
        kept = [f.name for f in schema if f.name in rows.columns]
        old, live = rows.where("status = 'F'"), rows.where("status <> 'F'")
        if "footnote_ids" in kept:
            old = old.withColumn("footnote_ids", as_listed)
        vintages = []
        for kind, found, declared in (("old", old, as_text(schema)), ("live", live, schema)):
            landing = shared_folder(spark, f"insider-{name}-{kind}")
            land(found.select(*kept), landing, name)
            read = pages.read_tables(spark, landing, {name: declared}, at_once=False)
            vintages.append(read[name])
        store_vintages(vintages, schema, f"{path}/insider/{name}", "form4")


def insider_lake(spark, folder) -> str:
    return written_once(
        spark, "insider-lake", folder, lambda path: store_insider(spark, folder, path)
    )


_INSIDER_SQL = f"{FORM_SQL} IN ('3', '4', '5/A') AND {_WINDOW_SQL}"


@query(
    "stored_insider",
    f"""WITH f AS (SELECT o_orderkey AS uuid FROM orders WHERE {_INSIDER_SQL}),
             l AS (SELECT l_orderkey AS uuid, l_returnflag AS flag FROM lineitem
                   WHERE l_orderkey IN (SELECT uuid FROM f))
        SELECT name, uuid::VARCHAR AS uuid, count(*) AS n_rows FROM (
          SELECT 'metadata' AS name, uuid FROM f UNION ALL SELECT 'general_info', uuid FROM f
          UNION ALL SELECT 'derivative_table', uuid FROM l WHERE flag = 'A'
          UNION ALL SELECT 'non_derivative_table', uuid FROM l WHERE flag = 'N'
          UNION ALL SELECT 'footnotes', uuid FROM l) GROUP BY 1, 2""",
)
def stored_insider(spark, folder):
    """Rows of each stored table for the filings of a window; one of the six tables has none."""
    store = FilingStore.open(spark, insider_lake(spark, folder))
    found = store.get_form4_payload(**WINDOW)
    named = [df.select(F.lit(name).alias("name"), "uuid") for name, df in found.items()]
    return reduce(DataFrame.unionByName, named).groupBy("name", "uuid").agg(
        F.count("*").alias("n_rows")
    )


@query(
    "stored_footnotes",
    f"""SELECT l_orderkey::VARCHAR AS uuid, l_linenumber AS line, count(*) AS n_rows,
               'Note ' || l_linenumber AS note
        FROM lineitem WHERE l_returnflag = 'A'
          AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE {_INSIDER_SQL}) GROUP BY 1, 2""",
)
def stored_footnotes(spark, folder):
    """Texts of the footnotes that a stored table lists; of each list, one id has no footnote."""
    store = FilingStore.open(spark, insider_lake(spark, folder))
    held = store.get_form4_payload(**WINDOW)
    rows = held["derivative_table"].groupBy("uuid", "footnote_ids").agg(F.count("*").alias("n_rows"))
    notes = held["footnotes"].select("uuid", "footnote_id", "footnote").distinct()
    found = payloads.resolve_footnotes(rows, notes, ["uuid", "footnote_ids", "n_rows"])
    line = F.substring(F.element_at("footnote_ids", 1), 2, 9).cast("int").alias("line")
    return found.select(
        "uuid", line, "n_rows", F.array_join(F.array_compact("footnotes"), "; ").alias("note")
    )


# The series catalog and its points.


def catalog_vintages(spark, folder) -> list[DataFrame]:
    """The historical vintage has all as text and `NA` for what is absent, the live one a unit."""
    rows = tables.catalog(spark, folder)
    old = rows.where("payload_id % 2 = 1")
    live = rows.where("payload_id % 2 = 0").withColumn("unit", F.lit("t"))
    absent = F.when(F.col("payload_id") % 10 == 3, "NA").otherwise(F.col("commodity"))
    return [old.withColumn("commodity", absent).withColumn("unit", F.lit(" ")), live]


def point_vintages(spark, folder) -> list[DataFrame]:
    """Values of the historical vintage are texts, `NA` and words among them."""
    number = F.col("event_id") % 100
    rows = series_points(spark, folder)
    token = F.when(number == 7, "many").when(number < 6, "NA")
    old = rows.where(number % 2 == 1).withColumn("original_value", F.coalesce(token, "original_value"))
    old = old.withColumn("value", F.coalesce(token, F.col("value").cast("string")))
    return [old, rows.where(number % 2 == 0)]


def catalog_lake(spark, folder) -> str:
    def write(path: str) -> None:
        lost = write_catalog(catalog_vintages(spark, folder), point_vintages(spark, folder), path)
        lost.write.parquet(f"{path}/lost")

    return written_once(spark, "catalog-lake", folder, write)


_COMMODITY = "CASE WHEN p_partkey % 10 <> 3 THEN p_type END"


@query(
    "stored_catalog",
    f"""SELECT p_partkey::VARCHAR AS payload_id, p_name AS name, {_COMMODITY} AS commodity,
               p_size::VARCHAR AS country, CASE WHEN p_partkey % 2 = 0 THEN 't' END AS unit
        FROM part WHERE {_COMMODITY} IN ('ECONOMY', 'SMALL') AND lower(p_name) LIKE '%ring%'""",
)
def stored_catalog(spark, folder):
    """A search of the stored catalog, where absent values of both vintages are NULL."""
    store = SeriesCatalog.open(spark, catalog_lake(spark, folder))
    found = store.search_all(text="ring", commodity=["ECONOMY", "SMALL"])
    return found.select("payload_id", "name", "commodity", "country", "unit")


def _is_old(condition: str) -> str:
    return f"event_id % 2 = 1 AND ({condition})"


@query(
    "stored_series",
    f"""SELECT event_type AS payload_id, strftime(ts, '%Y-M%m') AS original_period,
               CASE WHEN {_is_old("event_id % 100 = 7")} THEN 'many'
                    WHEN NOT ({_is_old("event_id % 100 < 6")}) THEN value::DECIMAL(12, 2)::VARCHAR
                    END AS original_value,
               CASE WHEN NOT ({_is_old("event_id % 100 < 6 OR event_id % 100 = 7")}) THEN value END AS value,
               last_day(ts)::VARCHAR AS period
        FROM events WHERE event_type = 'purchase'""",
)
def stored_series(spark, folder):
    """The points of a series from the stored table: what was `NA` is NULL."""
    points = SeriesCatalog.open(spark, catalog_lake(spark, folder)).get_payload("purchase")
    day = F.col("period").cast("string").alias("period")
    return points.select("payload_id", "original_period", "original_value", "value", day)


@query(
    "stored_series_failures",
    """SELECT 'series' AS table_name, 0 AS vintage, 'value' AS column_name, count(*) AS n_failed
       FROM events WHERE event_id % 100 = 7""",
)
def stored_series_failures(spark, folder):
    lost = spark.read.parquet(f"{catalog_lake(spark, folder)}/lost")
    return lost.select("table_name", "vintage", "column_name", "n_failed")
