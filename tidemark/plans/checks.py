"""Profiles, quality expectations and comparisons on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import profile, quality, setops, summaries
from tidemark.plans import driver_tables as tables
from tidemark.plans.registry import query
from tidemark.session import stored
from tidemark.sources.tables import read_table


@query("distinct_filers", "SELECT DISTINCT o_custkey AS cik FROM orders")
def distinct_filers(spark, folder):
    return profile.distinct_values(tables.filings(spark, folder), "cik")


@query(
    "distinct_counts",
    """SELECT 'cik' AS column_name, count(DISTINCT o_custkey) AS n_distinct FROM orders
       UNION ALL SELECT 'filing_date', count(DISTINCT o_orderdate) FROM orders
       UNION ALL SELECT 'form_type', count(DISTINCT o_orderpriority) FROM orders""",
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(
        tables.filings(spark, folder), "cik", "filing_date", "form_type"
    )


@query(
    "corner_values",
    """SELECT min(ts) AS min_ts, max(ts) AS max_ts, min(user_id) AS min_user_id,
              max(user_id) AS max_user_id, min(value) AS min_value, max(value) AS max_value
       FROM events""",
)
def corner_values(spark, folder):
    return profile.corner_values(read_table(spark, folder, "events"), "ts", "user_id", "value")


def documents_with_labels(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "lang", "source")
    return documents.join(read_table(spark, folder, "labels"), "doc_id", "left")


@query(
    "missing_count",
    """WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
       SELECT 'quality' AS column_name, count(*) FILTER (quality IS NULL) AS n_missing,
              count(*) AS n_rows FROM d
       UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL), count(*) FROM d""",
)
def missing_count(spark, folder):
    return profile.missing_counts(documents_with_labels(spark, folder), "quality", "lang")


@query(
    "missing_expectation",
    """WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
       SELECT 'quality' AS column_name, count(*) FILTER (quality IS NULL) AS n_missing,
              count(*) AS n_rows, 10::BIGINT AS n_allowed,
              count(*) FILTER (quality IS NULL) <= 10 AS met FROM d
       UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL), count(*), 0,
              count(*) FILTER (lang IS NULL) <= 0 FROM d""",
)
def missing_expectation(spark, folder):
    return quality.unexpected_missing(
        documents_with_labels(spark, folder), {"quality": 10, "lang": 0}
    )


@query(
    "missing_nan",
    """SELECT 'value' AS column_name, count(*) FILTER (event_type IN ('view', 'error')) AS n_missing,
              count(*) AS n_rows FROM events""",
)
def missing_nan(spark, folder):
    """Numbers of which some are NaN and some NULL."""
    value = F.when(F.col("event_type") == "view", F.lit(float("nan"))).when(
        F.col("event_type") != "error", F.col("value")
    )
    return profile.missing_counts(read_table(spark, folder, "events").select(value.alias("value")), "value")


_PROFILED = {
    "uuid": "o_orderkey::VARCHAR",
    "cik": "o_custkey::VARCHAR",
    "form_type": "o_orderpriority",
    "status": "o_orderstatus",
}


@query(
    "column_values",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {sql} AS value, count(*) AS n_rows FROM orders GROUP BY 2"
        for name, sql in _PROFILED.items()
    ),
)
def column_values(spark, folder):
    return profile.column_values(tables.filings(spark, folder), *_PROFILED)


_TYPED = {"uuid": "o_orderkey", "total": "o_totalprice::DECIMAL(12, 2)", "form_type": "o_orderpriority"}


@query(
    "column_profile",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count(DISTINCT {sql}) AS n_distinct,
            min({sql})::VARCHAR AS min_value, max({sql})::VARCHAR AS max_value,
            count(*) FILTER ({sql} IS NULL) AS n_missing, count(*) AS n_rows FROM orders"""
        for name, sql in _TYPED.items()
    ),
)
def column_profile(spark, folder):
    """Corners of numbers are those of the numbers, not of their texts."""
    filings = tables.filings(spark, folder)
    filings = filings.withColumn("total", F.col("total").cast("decimal(12,2)"))
    return profile.column_profile(filings, *_TYPED)


@query(
    "facet_profile",
    """SELECT 'cik' AS column_name, o_custkey::VARCHAR AS value,
              (SELECT count(DISTINCT o_custkey) FROM orders) AS n_distinct FROM orders GROUP BY 2
       UNION ALL SELECT 'status', o_orderstatus,
              (SELECT count(DISTINCT o_orderstatus) FROM orders) FROM orders GROUP BY 2""",
)
def facet_profile(spark, folder):
    return profile.facet_profile(tables.filings(spark, folder), "cik", "status")


_MONTH_SQL = "strftime(o_orderdate, '%Y-%m')"


def _month_profile_sql(month):
    distinct = {"form_type": "count(DISTINCT o_orderpriority)", "status": "count(DISTINCT o_orderstatus)"}
    return " UNION ALL ".join(
        f"""SELECT {month} AS month, '{name}' AS column_name, {distinct.get(name, 'NULL')} AS n_distinct,
            min({sql})::VARCHAR AS min_value, max({sql})::VARCHAR AS max_value,
            count(*) FILTER ({sql} IS NULL) AS n_missing, count(*) AS n_rows FROM orders"""
        + ("" if month == "NULL" else " GROUP BY 1")
        for name, sql in {**_TYPED, "status": "o_orderstatus"}.items()
    )


@query(
    "profile_by_month",
    f"{_month_profile_sql('NULL')} UNION ALL {_month_profile_sql(_MONTH_SQL)}",
)
def profile_by_month(spark, folder):
    """Months profiled in two loads, stored, and merged to months and to the whole. Few distinct
    values are counted exactly by the sketches; the estimates of the others are left out."""
    filings = tables.filings(spark, folder)
    filings = filings.withColumn("total", F.col("total").cast("decimal(12,2)"))
    first = F.coalesce(F.col("status") == "F", F.lit(False))
    month = F.date_format("filing_date", "yyyy-MM")
    loads = [
        summaries.part_profiles(filings.where(load), month, *_TYPED, "status") for load in (first, ~first)
    ]
    parts = stored(loads[0].unionByName(loads[1]))
    months = summaries.merged_profiles(parts, F.col("part"))
    rows = summaries.profile_rows(months.unionByName(summaries.merged_profiles(parts)))
    counted = F.when(F.col("column_name").isin("form_type", "status"), F.col("n_distinct"))
    return rows.withColumn("n_distinct", counted).withColumnRenamed("part", "month")


@query("rows_per_filer", "SELECT o_custkey AS cik, count(*) AS n_rows FROM orders GROUP BY 1")
def rows_per_filer(spark, folder):
    return profile.rows_per_key(tables.filings(spark, folder), "cik")


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, folder):
    return profile.row_count(tables.holding_lines(spark, folder))


# Expectations.


@query(
    "dup_keys",
    """SELECT l_orderkey AS uuid, l_partkey AS cusip, l_linenumber AS line, l_quantity AS quantity
       FROM lineitem WHERE (l_orderkey, l_linenumber) IN
         (SELECT (l_orderkey, l_linenumber) FROM lineitem
          GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def dup_keys(spark, folder):
    lines = tables.holding_lines(spark, folder).select("uuid", "cusip", "line", "quantity")
    return quality.duplicate_rows(lines, "uuid", "line")


@query(
    "dup_keys_null",
    """SELECT uuid, flag, line FROM (
         SELECT l_orderkey AS uuid, nullif(l_returnflag, 'N') AS flag, l_linenumber AS line,
                count(*) OVER (PARTITION BY l_orderkey, nullif(l_returnflag, 'N')) AS n
         FROM lineitem) WHERE n > 1""",
)
def dup_keys_null(spark, folder):
    """A key with a NULL in it repeats like any other."""
    lines = tables.holding_lines(spark, folder).select(
        "uuid", F.nullif("put_call", F.lit("N")).alias("flag"), "line"
    )
    return quality.duplicate_rows(lines, "uuid", "flag")


@query(
    "dup_values",
    """SELECT l_orderkey AS uuid, l_partkey AS cusip, count(*) AS n_rows FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dup_values(spark, folder):
    return quality.duplicated_values(tables.holding_lines(spark, folder), "uuid", "cusip")


@query(
    "range_conformance",
    """SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value,
              count(*) FILTER (NOT (o_orderdate >= TIMESTAMP '1995-01-01'
                                    AND o_orderdate < TIMESTAMP '2001-08-01')) AS n_outside,
              bool_and(o_orderdate >= TIMESTAMP '1995-01-01'
                       AND o_orderdate < TIMESTAMP '2001-08-01') AS conforms
       FROM orders""",
)
def range_conformance(spark, folder):
    return quality.range_conformance(
        tables.filings(spark, folder),
        "filing_date",
        F.lit("1995-01-01").cast("timestamp_ntz"),
        F.lit("2001-08-01").cast("timestamp_ntz"),
    )


@query(
    "reconcile",
    """SELECT o_orderkey AS uuid, 'left_only' AS side FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
       UNION ALL SELECT DISTINCT l_orderkey, 'right_only' FROM lineitem
       WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def reconcile(spark, folder):
    """Filings without a returned line, and returned lines without a filing."""
    returned = tables.holding_lines(spark, folder).where("put_call = 'A'")
    return setops.reconcile(tables.filings(spark, folder), returned, "uuid")


@query(
    "monotonic_violations",
    """SELECT item_name, count(*) AS n_rows, count(*) FILTER (value < prev) AS n_falls,
              count(*) FILTER (value = prev) AS n_repeats
       FROM (SELECT event_type AS item_name, value,
                    lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev
             FROM events) GROUP BY 1""",
)
def monotonic_violations(spark, folder):
    checked = quality.monotonic_violations(
        tables.item_facts(spark, folder),
        ["item_name"],
        ["form_availability_timestamp", "form_uuid"],
        "item_value",
    )
    return checked


@query(
    "strictly_increasing",
    """SELECT count(*) FILTER (event_id <= prev) = 0 AS increases, count(*) AS n_rows
       FROM (SELECT event_id, lag(event_id) OVER (ORDER BY ts, event_id) AS prev
             FROM events)""",
)
def strictly_increasing(spark, folder):
    """Event ids increase with time."""
    facts = tables.item_facts(spark, folder).withColumn("all", F.lit(0))
    checked = quality.monotonic_violations(
        facts, ["all"], ["form_availability_timestamp", "form_uuid"], "form_uuid"
    )
    return checked.select(
        ((F.col("n_falls") == 0) & (F.col("n_repeats") == 0)).alias("increases"), "n_rows"
    )


@query(
    "type_agreement",
    """WITH v AS (SELECT event_type, CASE WHEN event_type = 'click' THEN props
                    ELSE props->'$.k' END AS body FROM events),
            t AS (SELECT event_type, json_type(body) AS kind, json_keys(body) AS keys, body FROM v)
       SELECT event_type, CASE WHEN kind = 'OBJECT' THEN 'OBJECT<' || array_to_string(
                [k || ': ' || replace(json_type(body, '$.' || k), 'UBIGINT', 'BIGINT') FOR k IN keys],
                ', ') || '>' ELSE replace(kind, 'UBIGINT', 'BIGINT') END AS value_type,
              count(*) AS n_rows FROM t GROUP BY 1, 2""",
)
def type_agreement(spark, folder):
    """Types found in a variant column, per event type."""
    body = F.parse_json("props")
    number = F.variant_get(body, "$.k", "variant")
    values = read_table(spark, folder, "events").select(
        "event_type", F.when(F.col("event_type") == "click", body).otherwise(number).alias("body")
    )
    return quality.variant_types(values, "body", "event_type")


@query(
    "not_allowed_values",
    """SELECT o_custkey AS cik, count(*) AS n_rows FROM orders
       WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""",
)
def not_allowed_values(spark, folder):
    allowed = read_table(spark, folder, "events").select("user_id")
    return quality.not_allowed_values(tables.filings(spark, folder), "cik", allowed)


# Comparisons.


@query(
    "set_diff_report",
    """WITH a AS (SELECT DISTINCT o_custkey k FROM orders WHERE o_orderstatus = 'F'
                    AND o_orderdate < TIMESTAMP '1996-01-01'),
            b AS (SELECT DISTINCT o_custkey k FROM orders WHERE o_orderstatus = 'O'
                    AND o_orderdate >= TIMESTAMP '2001-01-01')
       SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right,
              (SELECT count(*) FROM a JOIN b USING (k)) AS n_both,
              (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS n_left_only,
              (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS n_right_only""",
)
def set_diff_report(spark, folder):
    filings = tables.filings(spark, folder)
    early = filings.where("status = 'F' AND filing_date < timestamp_ntz'1996-01-01'")
    late = filings.where("status = 'O' AND filing_date >= timestamp_ntz'2001-01-01'")
    return setops.set_diff_report(early, late, "cik")


@query(
    "set_relations",
    """WITH a AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'),
            b AS (SELECT o_custkey FROM orders)
       SELECT NOT EXISTS (FROM a EXCEPT FROM b) AS is_subset,
              NOT EXISTS (FROM a EXCEPT FROM b) AND NOT EXISTS (FROM b EXCEPT FROM a) AS is_equal,
              NOT EXISTS (FROM a INTERSECT FROM b) AS is_disjoint""",
)
def set_relations(spark, folder):
    filings = tables.filings(spark, folder)
    return setops.set_relations(filings.where("status = 'F'"), filings, "cik")


@query(
    "set_difference",
    """SELECT o_orderkey AS uuid FROM orders EXCEPT
       SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F'""",
)
def set_difference(spark, folder):
    closed = tables.holding_lines(spark, folder).where("line_status = 'F'")
    return setops.difference(tables.filings(spark, folder), closed, "uuid")


@query(
    "frame_diff",
    """SELECT o_orderkey AS uuid, o_custkey AS cik, 'F' AS status, 1::BIGINT AS n_left,
              0::BIGINT AS n_right
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_custkey, 'X', 0, 1 FROM orders WHERE o_orderstatus = 'F'""",
)
def frame_diff(spark, folder):
    """Filings against themselves with one status renamed."""
    filings = tables.filings(spark, folder).select("uuid", "cik", "status")
    renamed = F.when(F.col("status") == "F", "X").otherwise(F.col("status"))
    return setops.frame_diff(filings, filings.withColumn("status", renamed))


@query(
    "frame_diff_columns",
    """SELECT o_orderkey AS uuid, o_custkey AS cik, NULL::VARCHAR AS status, 1::BIGINT AS n_left,
              0::BIGINT AS n_right FROM orders
       UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 0, 1 FROM orders""",
)
def frame_diff_columns(spark, folder):
    """Frames of which one has a column more share no row."""
    filings = tables.filings(spark, folder)
    return setops.frame_diff(filings.select("uuid", "cik"), filings.select("uuid", "cik", "status"))


@query(
    "ordered_diff",
    """SELECT o_orderkey AS uuid, o_custkey AS left_value, user_id AS right_value
       FROM orders FULL JOIN events ON o_orderkey = event_id
       WHERE o_custkey IS DISTINCT FROM user_id""",
)
def ordered_diff(spark, folder):
    """Filers and event users as two lists, compared position by position."""
    filers = tables.filings(spark, folder).select("uuid", "cik")
    users = tables.item_facts(spark, folder).select(F.col("form_uuid").alias("uuid"), "cik")
    return setops.ordered_diff(filers, users, ["uuid"], "cik")


@query(
    "union_by_name",
    """SELECT o_orderkey AS uuid, o_custkey AS cik, o_totalprice AS total, NULL::VARCHAR AS item_name
       FROM orders UNION ALL SELECT event_id, user_id, NULL, event_type FROM events""",
)
def union_by_name(spark, folder):
    filings = tables.filings(spark, folder).select("uuid", "cik", "total")
    facts = tables.item_facts(spark, folder).select(
        "item_name", F.col("form_uuid").alias("uuid"), "cik"
    )
    return setops.union_by_name([filings, facts])


# Texts.


def document_lines(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    return text.explode_lines(documents, "text")


_LINES_SQL = """(SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""


@query(
    "text_clean",
    f"""SELECT doc_id, line_no::INT AS line_no, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS line
        FROM {_LINES_SQL} WHERE trim(regexp_replace(line, '\\s+', ' ', 'g')) <> ''""",
)
def text_clean(spark, folder):
    return text.clean_lines(document_lines(spark, folder))


@query(
    "line_filter",
    f"""SELECT doc_id, line_no::INT AS line_no, line FROM {_LINES_SQL}
        WHERE NOT regexp_matches(line, '[0-9]{{3,}}|^$')""",
)
def line_filter(spark, folder):
    return text.drop_lines(document_lines(spark, folder), "[0-9]{3,}|^$")


def _tidy_sql(value: str) -> str:
    """Lines of a text, each trimmed and with single blanks, blank ones left out."""
    return rf"""array_to_string([t FOR t IN
      [trim(regexp_replace(l, '[\t\v\f\r ]+', ' ', 'g')) FOR l IN string_split({value}, chr(10))]
      IF t <> ''], chr(10))"""


@query("text_collapse", f"SELECT doc_id, {_tidy_sql('text')} AS text FROM documents")
def text_collapse(spark, folder):
    documents = read_table(spark, folder, "documents")
    return documents.select("doc_id", text.tidy_lines("text").alias("text"))


@query(
    "frame_diff_fuzzy",
    f"""WITH d AS (SELECT doc_id::VARCHAR AS doc_id, {_tidy_sql('text')} AS here,
                 CASE lang WHEN 'de' THEN {_tidy_sql("text || ' #'")}
                           WHEN 'fr' THEN {_tidy_sql("replace(text, chr(10), ' ')")}
                           ELSE {_tidy_sql('text')} END AS there FROM documents)
        SELECT doc_id, here AS text, 1::BIGINT AS n_left, 0::BIGINT AS n_right FROM d
        WHERE here <> there
        UNION ALL SELECT doc_id, there, 0, 1 FROM d WHERE here <> there""",
)
def frame_diff_fuzzy(spark, folder):
    """Documents against a copy with other blanks; in one language with one more mark, in another
    with the lines joined, which is a difference."""
    documents = read_table(spark, folder, "documents")
    spaced = F.concat(F.lit("\t"), F.replace("text", F.lit(" "), F.lit("  ")))
    changed = (
        F.when(F.col("lang") == "de", F.concat(spaced, F.lit(" #\n\n")))
        .when(F.col("lang") == "fr", F.replace("text", F.lit("\n"), F.lit(" ")))
        .otherwise(F.replace(spaced, F.lit("\n"), F.lit("\n \n")))
    )
    left = documents.select("doc_id", "text")
    return setops.frame_diff(left, documents.select("doc_id", changed.alias("text")), fuzzy=True)


@query(
    "frame_digest_diff",
    """SELECT l_orderkey AS uuid, l_linenumber AS line, l_quantity AS quantity,
              count(*) FILTER (side = 0) AS n_left, count(*) FILTER (side = 1) AS n_right
       FROM (SELECT l_orderkey, l_linenumber, l_quantity, 0 AS side FROM lineitem
             UNION ALL
             SELECT l_orderkey, l_linenumber, l_quantity + CASE WHEN l_orderkey % 997 = 0 THEN 1 ELSE 0 END, 1
             FROM lineitem)
       GROUP BY 1, 2, 3 HAVING n_left <> n_right""",
)
def frame_digest_diff(spark, folder):
    """Lines against a copy in which those of a few filings changed."""
    lines = tables.holding_lines(spark, folder).select("uuid", "line", "quantity")
    changed = F.col("quantity") + F.when(F.col("uuid") % 997 == 0, 1).otherwise(0)
    return setops.frame_digest_diff(lines, lines.withColumn("quantity", changed))


@query(
    "document_diff",
    """SELECT event_id AS uuid, count(*) FILTER (side = 0) AS n_left, count(*) FILTER (side = 1) AS n_right
       FROM (SELECT event_id, props AS body, 0 AS side FROM events
             UNION ALL SELECT event_id, CASE WHEN event_type = 'error' THEN '{"k": -1}' ELSE props END, 1
             FROM events)
       GROUP BY event_id, body HAVING n_left <> n_right""",
)
def document_diff(spark, folder):
    """Documents (VARIANT) against a copy in which those of one kind changed."""
    events = read_table(spark, folder, "events")
    body = F.when(F.col("event_type") == "error", '{"k": -1}').otherwise(F.col("props"))
    left = events.select(F.col("event_id").alias("uuid"), F.parse_json("props").alias("data"))
    right = events.select(F.col("event_id").alias("uuid"), F.parse_json(body).alias("data"))
    return setops.frame_digest_diff(left, right).drop("data")
