"""Filing queries on the driver tables: windows, ids, payloads, mappings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import asof, ids, payloads, versions, windows
from tidemark.functions import conform
from tidemark.plans import driver_tables as tables
from tidemark.plans.driver_tables import FORM_FAMILIES, FORM_TYPES, ID_MAP_SQL
from tidemark.plans.ordering import with_position
from tidemark.plans.registry import query
from tidemark.sources.tables import read_table

PUBLISHED = dict(
    start_datetime="1996-03-15T12:00:00+00:00",
    end_datetime="2000-06-01T18:30:00+00:00",
    date_mode="publication_date",
)
KNOWN = dict(
    start_datetime="2024-01-05T21:11:20+00:00",
    end_datetime="2024-01-20T08:45:19-05:00",
    date_mode="knowledge_date",
)
_PUBLISHED_SQL = "o_orderdate >= TIMESTAMP '1996-03-15' AND o_orderdate < TIMESTAMP '2000-06-01'"
_KNOWN_SQL = "ts >= TIMESTAMP '2024-01-05 21:11:20' AND ts < TIMESTAMP '2024-01-20 13:45:19'"
_FILING_SQL = """o_orderkey AS uuid, o_custkey AS cik, o_orderdate AS filing_date,
       o_orderpriority AS form_type, o_orderstatus AS status, o_totalprice AS total"""
_LINE_SQL = """l_orderkey AS uuid, l_partkey AS cusip, l_linenumber AS line, l_quantity AS quantity,
       l_returnflag AS put_call, l_linestatus AS line_status,
       l_shipdate AS form_availability_timestamp"""


_PLACE_SQL = "row_number() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS position"


def segment_filers(spark, folder, segment="BUILDING"):
    customers = read_table(spark, folder, "customer").where(F.col("c_mktsegment") == segment)
    return customers.select(F.col("c_custkey").alias("cik"))


@query(
    "header_query",
    f"""SELECT {_FILING_SQL}, {_PLACE_SQL} FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND {_PUBLISHED_SQL}
          AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def header_query(spark, folder):
    headers = payloads.form_headers(
        tables.filings(spark, folder),
        form_type=["1-URGENT", "2-HIGH"],
        cik=segment_filers(spark, folder),
        unique_ids=True,
        valid_types=FORM_TYPES,
        **PUBLISHED,
    )
    return with_position(headers)


@query("publication_window", f"SELECT {_FILING_SQL} FROM orders WHERE {_PUBLISHED_SQL}")
def publication_window(spark, folder):
    return windows.date_window(tables.filings(spark, folder), **PUBLISHED)


@query(
    "knowledge_window",
    f"""SELECT event_id AS form_uuid, user_id AS cik, event_type AS item_name, value AS item_value,
        ts AS form_availability_timestamp FROM events WHERE {_KNOWN_SQL}""",
)
def knowledge_window(spark, folder):
    return windows.date_window(tables.item_facts(spark, folder), **KNOWN).drop("filing_date")


@query(
    "open_window",
    f"SELECT {_FILING_SQL} FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'",
)
def open_window(spark, folder):
    """One bound alone."""
    return windows.date_window(
        tables.filings(spark, folder),
        start_datetime="1999-01-01T09:30:00+00:00",
        date_mode="publication_date",
    )


@query(
    "id_semi_join",
    f"""SELECT {_FILING_SQL} FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def id_semi_join(spark, folder):
    wanted = segment_filers(spark, folder, "MACHINERY")
    return ids.filter_filers(tables.filings(spark, folder), wanted, unique=True)


@query(
    "id_list_equivalence",
    """WITH m AS (SELECT o_orderkey FROM orders JOIN
                    (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase') e
                    ON o_custkey = user_id)
       , l AS (SELECT o_orderkey FROM orders WHERE EXISTS
                 (SELECT 1 FROM events WHERE event_type = 'purchase' AND user_id = o_custkey))
       SELECT (SELECT count(*) FROM l) AS n_listed, (SELECT count(*) FROM m) AS n_flagged,
              NOT EXISTS (FROM l EXCEPT ALL FROM m) AND NOT EXISTS (FROM m EXCEPT ALL FROM l)
                AS is_equal""",
)
def id_list_equivalence(spark, folder):
    """Filtering by a list with repeats, and flagging members, keep the same rows."""
    filings = tables.filings(spark, folder)
    buyers = read_table(spark, folder, "events").where("event_type = 'purchase'").select("user_id")
    listed = ids.filter_filers(filings, buyers).select("uuid", F.lit(1).alias("l"), F.lit(0).alias("f"))
    flagged = ids.filter_membership(filings, "cik", buyers)
    both = listed.unionAll(flagged.select("uuid", F.lit(0).alias("l"), F.lit(1).alias("f")))
    times = both.groupBy("uuid").agg(F.sum("l").alias("l"), F.sum("f").alias("f"))
    return times.agg(
        F.sum("l").alias("n_listed"),
        F.sum("f").alias("n_flagged"),
        F.bool_and(F.col("l") == F.col("f")).alias("is_equal"),
    )


@query(
    "form_family_filter",
    f"""SELECT {_FILING_SQL} FROM orders
        WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""",
)
def form_family_filter(spark, folder):
    return ids.filter_family(tables.filings(spark, folder), "slow", FORM_FAMILIES)


@query(
    "real_time_split",
    """SELECT ts >= TIMESTAMP '2024-01-16' AS is_real_time, event_type AS item_name,
              count(*) AS n_rows
       FROM events GROUP BY 1, 2""",
)
def real_time_split(spark, folder):
    loaded = F.lit("2024-01-16").cast("timestamp_ntz")
    facts = tables.item_facts(spark, folder).withColumn(
        "is_real_time", F.col("form_availability_timestamp") >= loaded
    )
    halves = [
        ids.filter_real_time(facts, live=live).groupBy("is_real_time", "item_name")
        for live in (True, False)
    ]
    counts = [half.agg(F.count("*").alias("n_rows")) for half in halves]
    return counts[0].unionByName(counts[1])


@query(
    "asof_key_lookup",
    f"""WITH m AS ({ID_MAP_SQL})
        SELECT o_orderkey AS uuid, lpad(o_custkey::VARCHAR, 10, '0') AS cik,
               o_orderdate AS filing_date, gvk, effdate, thrudate
        FROM orders LEFT JOIN m ON m.cik = lpad(o_custkey::VARCHAR, 10, '0')
         AND effdate <= o_orderdate AND o_orderdate <= thrudate""",
)
def asof_key_lookup(spark, folder):
    """Each filing with the company key its filer had on the filing day."""
    filings = asof.padded_keys(
        tables.filings(spark, folder).select("uuid", "cik", "filing_date")
    )
    return asof.attach_as_of(filings, tables.id_map(spark, folder), "cik", "filing_date")


@query(
    "asof_company_lookup",
    f"""WITH m AS ({ID_MAP_SQL}),
             f AS (SELECT gvk, effdate + INTERVAL 100 DAY AS asked FROM m)
        SELECT f.gvk, f.asked, m.cik FROM f JOIN m
          ON f.gvk = m.gvk AND effdate <= asked AND asked <= thrudate""",
)
def asof_company_lookup(spark, folder):
    """Filer behind each company key a hundred days after the key began."""
    id_map = tables.id_map(spark, folder)
    asked = id_map.select("gvk", (F.col("effdate") + F.expr("INTERVAL 100 DAY")).alias("asked"))
    found = asof.attach_as_of(asked, id_map, "gvk", "asked", how="inner")
    return found.select("gvk", "asked", "cik")


@query(
    "mapping_as_of",
    f"""SELECT * FROM ({ID_MAP_SQL})
        WHERE effdate <= TIMESTAMP '1998-07-01' AND TIMESTAMP '1998-07-01' <= thrudate""",
)
def mapping_as_of(spark, folder):
    return asof.mapping_as_of(tables.id_map(spark, folder), as_of_date="1998-07-01")


@query(
    "mapping_conflicts",
    """WITH m AS (SELECT o_custkey AS cik, o_orderdate AS first,
                        o_orderdate + to_days((o_orderkey % 200 - 3)::INTEGER) AS last FROM orders),
            s AS (SELECT *, max(last) OVER (PARTITION BY cik ORDER BY first, last
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
                  FROM m WHERE first <= last)
       SELECT cik, 'overlap' AS kind, first, least(last, reached) AS last FROM s WHERE first <= reached
       UNION ALL SELECT cik, 'gap', reached + INTERVAL 1 DAY, first - INTERVAL 1 DAY FROM s
       WHERE reached + INTERVAL 1 DAY <= first - INTERVAL 1 DAY
       UNION ALL SELECT cik, 'inverted', first, last FROM m WHERE last < first""",
)
def mapping_conflicts(spark, folder):
    """Filings as mapping rows of varying length: days that several rows cover, or none."""
    rows = tables.filings(spark, folder)
    days = F.make_dt_interval((F.col("uuid") % 200 - 3).cast("int"))
    rows = rows.select(
        "cik", F.col("filing_date").alias("effdate"), (F.col("filing_date") + days).alias("thrudate")
    )
    return asof.mapping_conflicts(rows, "cik")


@query(
    "known_at",
    """SELECT l_orderkey AS uuid, l_linenumber AS line, l_partkey AS cusip, l_quantity AS quantity,
              l_shipdate AS form_availability_timestamp
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                     ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC) AS nth
             FROM lineitem WHERE l_shipdate <= TIMESTAMP '1996-06-30') WHERE nth = 1""",
)
def known_at(spark, folder):
    """Each filing in the version that was known of it on a day."""
    lines = tables.holding_lines(spark, folder).select(
        "uuid", "line", "cusip", "quantity", "form_availability_timestamp"
    )
    day, known = dt.datetime(1996, 6, 30), "form_availability_timestamp"
    return versions.known_at(lines, ["uuid"], known, day, tie=["line", "cusip", "quantity"])


@query(
    "known_restated",
    """SELECT * FROM (
         SELECT l_orderkey AS uuid, count(*) AS n_versions, min(l_shipdate) AS first_known,
                max(l_shipdate) AS last_known
         FROM (SELECT DISTINCT l_orderkey, l_partkey, l_shipdate FROM lineitem) GROUP BY 1)
       WHERE n_versions > 1""",
)
def known_restated(spark, folder):
    """Filings of which several versions became known."""
    lines = tables.holding_lines(spark, folder).select("uuid", "cusip", "form_availability_timestamp")
    return versions.restated(lines, ["uuid"], "form_availability_timestamp")


@query(
    "filer_multi_lookup",
    f"""SELECT DISTINCT m.cik FROM ({ID_MAP_SQL}) m
        JOIN customer ON m.cik = lpad(c_custkey::VARCHAR, 10, '0')
        WHERE c_mktsegment = 'FURNITURE'
          AND effdate <= TIMESTAMP '1999-03-31' AND TIMESTAMP '1999-03-31' <= thrudate""",
)
def filer_multi_lookup(spark, folder):
    return ids.find_filers(
        tables.id_map(spark, folder),
        tables.filers(spark, folder),
        gvk_date="1999-03-31",
        ticker="FURNITURE",
    )


@query(
    "key_padding",
    """SELECT c_custkey AS cik, lpad(c_custkey::VARCHAR, 10, '0') AS padded,
              c_custkey AS unpadded FROM customer""",
)
def key_padding(spark, folder):
    padded = conform.pad_key("cik", asof.CIK_WIDTH)
    return (
        read_table(spark, folder, "customer")
        .select(F.col("c_custkey").alias("cik"))
        .withColumn("padded", padded)
        .withColumn("unpadded", conform.unpad_key("padded"))
    )


def insider_tables(spark, folder):
    return {"metadata": tables.filings(spark, folder), "lines": tables.holding_lines(spark, folder)}


@query(
    "payload_parent",
    f"SELECT {_FILING_SQL} FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND {_PUBLISHED_SQL}",
)
def payload_parent(spark, folder):
    return payloads.insider_payload(
        insider_tables(spark, folder),
        form_type=FORM_FAMILIES["fast"],
        valid_types=FORM_TYPES,
        **PUBLISHED,
    )["metadata"]


@query(
    "payload_children",
    f"""SELECT {_LINE_SQL} FROM lineitem WHERE l_orderkey IN
        (SELECT o_orderkey FROM orders
         WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND {_PUBLISHED_SQL})""",
)
def payload_children(spark, folder):
    return payloads.insider_payload(
        insider_tables(spark, folder),
        form_type=FORM_FAMILIES["fast"],
        valid_types=FORM_TYPES,
        **PUBLISHED,
    )["lines"]


def holding_tables(spark, folder):
    filings = tables.filings(spark, folder)
    return {
        "metadata": filings.drop("total"),
        "header_data": filings.select("uuid", "cik", "total"),
        "information_table": tables.holding_lines(spark, folder),
    }


def economy_parts(spark, folder):
    parts = read_table(spark, folder, "part").where("p_type = 'ECONOMY'")
    return parts.select(F.col("p_partkey").alias("cusip"))


def security_holdings(spark, folder):
    return payloads.holdings_payload(
        holding_tables(spark, folder),
        cusip=economy_parts(spark, folder),
        unique_ids=True,
        form_type=FORM_FAMILIES["slow"],
        valid_types=FORM_TYPES,
        **PUBLISHED,
    )


_SLOW_SQL = f"""SELECT o_orderkey FROM orders
  WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') AND {_PUBLISHED_SQL}"""
_HELD_SQL = f"""SELECT l_orderkey FROM lineitem
  WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')
    AND l_orderkey IN ({_SLOW_SQL})"""


@query(
    "holdings_by_security",
    f"""SELECT {_LINE_SQL}, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_linenumber,
          l_quantity, l_returnflag, l_linestatus, l_shipdate) AS position FROM lineitem
        WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')
          AND l_orderkey IN ({_SLOW_SQL})""",
)
def holdings_by_security(spark, folder):
    lines = security_holdings(spark, folder)["information_table"]
    return with_position(payloads.ordered_holdings(lines))


@query(
    "holdings_by_security_metadata",
    f"""SELECT o_orderkey AS uuid, o_custkey AS cik, o_orderdate AS filing_date,
        o_orderpriority AS form_type, o_orderstatus AS status
        FROM orders WHERE o_orderkey IN ({_HELD_SQL})""",
)
def holdings_by_security_metadata(spark, folder):
    return security_holdings(spark, folder)["metadata"]


@query(
    "holdings_by_security_headers",
    f"""SELECT o_orderkey AS uuid, o_custkey AS cik, o_totalprice AS total
        FROM orders WHERE o_orderkey IN ({_HELD_SQL})""",
)
def holdings_by_security_headers(spark, folder):
    return security_holdings(spark, folder)["header_data"]


@query(
    "holdings_by_filer",
    f"""SELECT {_LINE_SQL} FROM lineitem WHERE l_orderkey IN
        ({_SLOW_SQL} AND o_custkey IN
          (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE'))""",
)
def holdings_by_filer(spark, folder):
    return payloads.holdings_payload(
        holding_tables(spark, folder),
        cik=segment_filers(spark, folder, "AUTOMOBILE"),
        unique_ids=True,
        form_type=FORM_FAMILIES["slow"],
        valid_types=FORM_TYPES,
        **PUBLISHED,
    )["information_table"]


@query(
    "item_payload",
    f"""SELECT event_id AS form_uuid, user_id AS cik, event_type AS item_name,
        value AS item_value, ts AS filing_date, ts AS form_availability_timestamp,
        row_number() OVER (ORDER BY ts, user_id, event_type, event_id) AS position
        FROM events WHERE event_type = 'purchase' AND {_KNOWN_SQL}""",
)
def item_payload(spark, folder):
    found = payloads.item_payload(tables.item_facts(spark, folder), item="purchase", **KNOWN)
    return with_position(found)


@query(
    "item_dictionary_join",
    """SELECT l_orderkey AS uuid, l_partkey AS item_name, l_linenumber AS line,
              l_quantity AS quantity, p_name AS description
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def item_dictionary_join(spark, folder):
    facts = tables.holding_lines(spark, folder).select(
        "uuid", F.col("cusip").alias("item_name"), "line", "quantity"
    )
    dictionary = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("description")
    )
    return payloads.describe_items(facts, dictionary)


@query(
    "footnote_resolution",
    """SELECT event_id, concat_ws('; ', CASE WHEN value >= 10 THEN 'status ' || o_orderstatus END,
                CASE WHEN event_type <> 'view' THEN 'priority ' || o_orderpriority END)
         AS footnotes,
         (value >= 10)::INT + (event_type <> 'view')::INT + (value >= 20)::INT AS n_listed
       FROM events LEFT JOIN orders ON o_orderkey = event_id""",
)
def footnote_resolution(spark, folder):
    """Events carry a footnote list into the filing of the same number, which some lack; `F9` is a
    mark no filing explains."""
    events = read_table(spark, folder, "events")
    marks = F.array_compact(
        F.array(
            F.when(F.col("value") >= 10, "F1"),
            F.when(F.col("event_type") != "view", "F2"),
            F.when(F.col("value") >= 20, "F9"),
        )
    )
    filings = tables.filings(spark, folder)
    rows = events.select(
        F.col("event_id"), F.col("event_id").alias("uuid"), marks.alias("footnote_ids")
    )

    def note(mark, text):
        return F.struct(F.lit(mark).alias("footnote_id"), text.alias("footnote"))

    notes = filings.select(
        "uuid",
        F.inline(
            F.array(
                note("F1", F.concat(F.lit("status "), "status")),
                note("F2", F.concat(F.lit("priority "), "form_type")),
            )
        ),
    )
    resolved = payloads.resolve_footnotes(rows, notes, ["event_id"])
    return resolved.select(
        "event_id",
        F.array_join("footnotes", "; ").alias("footnotes"),
        F.size("footnotes").alias("n_listed"),
    )


@query(
    "multi_key_sort",
    f"""SELECT {_FILING_SQL}, row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_custkey,
          o_orderkey) AS position FROM orders""",
)
def multi_key_sort(spark, folder):
    filings = tables.filings(spark, folder)
    return with_position(filings.orderBy("form_type", *payloads.HEADER_ORDER))


@query(
    "first_rows",
    f"SELECT {_FILING_SQL}, {_PLACE_SQL} FROM orders ORDER BY position LIMIT 100",
)
def first_rows(spark, folder):
    return with_position(tables.filings(spark, folder).orderBy(*payloads.HEADER_ORDER).limit(100))


@query(
    "last_rows",
    f"""SELECT * REPLACE (position - (SELECT count(*) FROM orders) + 100 AS position) FROM
        (SELECT {_FILING_SQL}, {_PLACE_SQL} FROM orders) ORDER BY position DESC LIMIT 100""",
)
def last_rows(spark, folder):
    """The last rows, in ascending order."""
    last = tables.filings(spark, folder).orderBy(*[F.desc(c) for c in payloads.HEADER_ORDER])
    return with_position(last.limit(100).orderBy(*payloads.HEADER_ORDER))


# Documents: event bodies as variants.


def documents(spark, folder):
    """Events as documents: column-oriented meta and a nested, mixed-type body."""
    meta = F.concat(
        F.lit('{"cik":{"0":'), F.col("user_id"), F.lit('},"form_type":{"0":"'),
        F.col("event_type"), F.lit('"}}'),
    )
    body = F.concat(
        F.lit('{"calculation":{"calculationLinkbase":[["linkRole",'), F.col("props"),
        F.lit(',{},["concept",{"label":"'), F.col("event_type"), F.lit('"}]]]}}'),
    )
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("uuid"),
        F.col("ts").alias("form_availability_timestamp"),
        F.parse_json(meta).alias("meta"),
        F.parse_json(body).alias("data"),
    )


@query(
    "document_meta",
    "SELECT event_id AS uuid, user_id AS cik, event_type AS form_type FROM events",
)
def document_meta(spark, folder):
    flat = payloads.flatten_meta(
        documents(spark, folder).select("uuid", "meta"), {"cik": "bigint", "form_type": "string"}
    )
    return flat.select("uuid", "cik", "form_type")


@query(
    "document_extract",
    f"""SELECT event_id AS uuid, (props->>'$.k')::BIGINT AS k, event_type AS label,
               NULL::VARCHAR AS absent
        FROM events WHERE {_KNOWN_SQL}""",
)
def document_extract(spark, folder):
    found = payloads.document_payload(documents(spark, folder), **KNOWN)
    link = "$.calculation.calculationLinkbase[0]"
    return found.select(
        "uuid",
        payloads.document_path("data", f"{link}[1].k", "bigint").alias("k"),
        payloads.document_path("data", f"{link}[3][1].label", "string").alias("label"),
        payloads.document_path("data", "$.presentation", "string").alias("absent"),
    )


@query(
    "document_nodes",
    """SELECT event_id AS uuid, pos, CASE pos WHEN 0 THEN '"linkRole"'
              WHEN 1 THEN replace(props, ' ', '') WHEN 2 THEN '{}'
              ELSE '["concept",{"label":"' || event_type || '"}]' END AS node
       FROM events, (VALUES (0), (1), (2), (3)) v(pos)""",
)
def document_nodes(spark, folder):
    nodes = payloads.document_nodes(
        documents(spark, folder).select("uuid", "data"),
        "data",
        "$.calculation.calculationLinkbase[0]",
    )
    return nodes.select("uuid", "pos", F.to_json("value").alias("node"))


@query(
    "document_by_uuid",
    """SELECT doc_id AS uuid, text, lang FROM documents
       WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def document_by_uuid(spark, folder):
    documents = read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("uuid"), "text", "lang"
    )
    wanted = read_table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return payloads.document_by_uuid(documents, wanted)
