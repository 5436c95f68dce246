"""Ingest and sync queries: the driver tables are landed as files, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import versions
from tidemark.operators.windows import date_window
from tidemark.plans import driver_tables as tables
from tidemark.plans.registry import query
from tidemark.session import shared_folder, written_once
from tidemark.sources import files, pages
from tidemark.sources.tables import read_table
from tidemark.streaming import marks, sync

PAGE_ROWS = 500
PAGE = "_page"
BASE = "https://filings.example.org/headers"

FILING_ROW = schemas.struct(
    uuid=schemas.LONG,
    cik=schemas.LONG,
    filing_date=schemas.ZONELESS,
    form_type=schemas.STRING,
    status=schemas.STRING,
    total=schemas.DOUBLE,
)
LINE_ROW = schemas.struct(
    uuid=schemas.LONG,
    cusip=schemas.LONG,
    line=schemas.INT,
    quantity=schemas.DOUBLE,
    put_call=schemas.STRING,
    line_status=schemas.STRING,
    form_availability_timestamp=schemas.ZONELESS,
)
# Page bookkeeping counts rows and parses no more of them than the key.
KEY_ROW = schemas.struct(uuid=schemas.LONG)
FACT_ROW = schemas.struct(
    form_uuid=schemas.LONG,
    cik=schemas.LONG,
    item_name=schemas.STRING,
    item_value=schemas.DOUBLE,
    form_availability_timestamp=schemas.ZONELESS,
)


def paged(rows: DataFrame, number: Column, request: Column, table: str | None = None) -> DataFrame:
    """Envelopes of at most 500 rows; `number` must give no page more than that."""
    body = F.struct(*[F.col(c) for c in rows.columns if c != PAGE])
    listed = rows.groupBy(request.alias("request"), number.alias("page")).agg(
        F.collect_list(body).alias("data")
    )
    return _envelopes(rows, listed, number, request, table)


def paged_by_row(rows: DataFrame, request: Column, table: str | None = None) -> DataFrame:
    """Texts of envelopes of at most 500 rows that lie next to each other in the scan.

    A page is made where its rows are: each task joins the JSON of its rows page by page, batch by
    batch, so nothing is shuffled or sorted and a task holds a batch, however many rows it reads.
    """
    number = by_row(rows)
    text = F.to_json(F.struct(*rows.columns), files.MICROSECONDS)
    found = number.select(request.alias("request"), F.col(PAGE).alias("page"), text.alias("text"))
    listed = found.mapInArrow(_joiner(), "request string, page bigint, data string")
    pages = _envelopes(number, listed, F.col(PAGE), request, None)
    before, behind = (f'{{"{table}":[', "]}}") if table else ("[", "]}")
    head = F.to_json(F.struct("links", "count"))
    head = F.substring(head, F.lit(1), F.length(head) - 1)
    return pages.select(
        F.concat(head, F.lit(f',"data":{before}'), "data", F.lit(behind)).alias("value")
    )


def _joiner():
    """Function of the Arrow batches of one task, rows in order of their pages, to the joined texts of
    each page and request; a page that a batch breaks off goes on with the next one."""

    def join(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def joined(rows):
            if pc.count_distinct(rows["request"], mode="all").as_py() > 1:
                rows = rows.take(pc.sort_indices(rows, [("page", "ascending"), ("request", "ascending")]))
            request = rows["request"].combine_chunks()
            page = rows["page"].to_numpy()
            asked = pc.fill_null(request.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            begins = np.ones(len(page), dtype=bool)
            begins[1:] = (page[1:] != page[:-1]) | (asked[1:] != asked[:-1])
            starts = np.flatnonzero(begins)
            ends = pa.array([*starts, len(page)], pa.int32())
            lists = pa.ListArray.from_arrays(ends, rows["text"].combine_chunks())
            columns = [request.take(pa.array(starts)), pa.array(page[starts]), pc.binary_join(lists, ",")]
            return pa.RecordBatch.from_arrays(columns, ["request", "page", "data"])

        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if rows.num_rows:
                end = pc.index(rows["page"], rows["page"][-1]).as_py()
                if end:
                    yield joined(rows.slice(0, end))
                rest = rows.slice(end)
        if rest is not None and rest.num_rows:
            yield joined(rest)

    return join


def _envelopes(
    rows: DataFrame, listed: DataFrame, number: Column, request: Column, table: str | None
) -> DataFrame:
    """Lists of rows with the links and totals of their request.

    With `table`, the rows sit under that name, as in multi-table payloads. There
    are at most five requests (one per form type), so their totals are broadcast.
    """
    totals = rows.groupBy(request.alias("request")).agg(
        F.count("*").alias("count"),
        F.max(number).alias("last_page"),
        F.min(number).alias("first_page"),
    )

    def link(page):
        return F.concat("request", F.lit("&offset="), (page * PAGE_ROWS).cast("string"))

    data = F.struct(F.col("data").alias(table)).alias("data") if table else F.col("data")
    return listed.join(F.broadcast(totals), "request").select(
        F.struct(
            link(F.col("page")).alias("self"),
            link(F.col("first_page")).alias("first"),
            link(F.col("last_page")).alias("last"),
            F.when(F.col("page") < F.col("last_page"), link(F.col("page") + 1)).alias("next"),
        ).alias("links"),
        "count",
        data,
    )


def by_key(key: str) -> Column:
    """Page number from a unique integer key."""
    return F.expr(f"{key} div {PAGE_ROWS}")


def by_row(rows: DataFrame) -> DataFrame:
    """Rows with a page number from their place in the scan, which needs no key."""
    return rows.withColumn(PAGE, F.expr(f"monotonically_increasing_id() div {PAGE_ROWS}"))


def form_request() -> Column:
    return F.concat(F.lit(f"{BASE}?form_type="), F.left("form_type", F.lit(1)))


def land_filings(spark, folder) -> str:
    """Pages of the filings of each form type, numbered by filing, the offset amid the link."""
    pages = paged(tables.filings(spark, folder), by_key("uuid"), form_request())
    moved = F.regexp_replace("links.self", r"\?(form_type=\d)&(offset=\d+)$", "?$2&$1")
    pages = pages.withColumn("links", F.col("links").withField("self", moved))
    return written_once(spark, "filing-pages", folder, lambda path: files.write_pages(pages, path))


_FILING_SQL = """o_orderkey AS uuid, o_custkey AS cik, o_orderdate AS filing_date,
  o_orderpriority AS form_type, o_orderstatus AS status, o_totalprice AS total"""


@query("page_ingest", f"SELECT {_FILING_SQL} FROM orders")
def page_ingest(spark, folder):
    landed = paged_by_row(tables.filings(spark, folder), form_request())
    path = written_once(spark, "row-pages", folder, lambda path: files.write_page_texts(landed, path))
    return pages.page_rows(pages.read_pages(spark, path, FILING_ROW))


@query(
    "page_rejects",
    """WITH p AS (SELECT o_orderpriority[1] IN ('3', '4') AS bad, count(*) AS n
                  FROM orders GROUP BY o_orderpriority, o_orderkey // 500, bad)
       SELECT CASE WHEN bad THEN 'rejected' ELSE 'read' END AS fate, count(*) AS n_pages,
              CASE WHEN NOT bad THEN sum(n)::BIGINT END AS n_rows FROM p GROUP BY bad""",
)
def page_rejects(spark, folder):
    """Landed pages, those of one request cut off, those of another error bodies."""
    whole = spark.read.text(land_filings(spark, folder))
    body = F.col("value")
    broken = whole.select(
        F.when(body.contains("form_type=3"), F.expr("left(value, length(value) - 9)"))
        .when(body.contains("form_type=4"), F.lit('{"message": "no such form"}'))
        .otherwise(body)
        .alias("value")
    )
    path = written_once(spark, "broken-pages", folder, broken.write.text)
    good, rejects = pages.split_pages(spark, path, KEY_ROW)
    read = good.agg(F.count("*").alias("n_pages"), F.sum(F.size("data")).alias("n_rows"))
    lost = rejects.agg(F.count("*").alias("n_pages"), F.lit(None).cast("bigint").alias("n_rows"))
    return read.select(F.lit("read").alias("fate"), "*").unionByName(
        lost.select(F.lit("rejected").alias("fate"), "*")
    )


@query(
    "page_offsets",
    f"""SELECT '{BASE}?form_type=' || o_orderpriority[1] AS request,
               (o_orderkey // 500) * 500 AS page_start, count(*) AS n_rows,
               max(o_orderkey // 500) OVER (PARTITION BY o_orderpriority[1]) = o_orderkey // 500
                 AS is_last
        FROM orders GROUP BY o_orderpriority[1], o_orderkey // 500""",
)
def page_offsets(spark, folder):
    read = pages.read_pages(spark, land_filings(spark, folder), KEY_ROW)
    return read.select(
        pages.page_request().alias("request"),
        pages.page_offset().alias("page_start"),
        F.size("data").cast("bigint").alias("n_rows"),
        F.col("links.next").isNull().alias("is_last"),
    )


@query(
    "page_completeness",
    f"""WITH p AS (SELECT '{BASE}?form_type=' || o_orderpriority[1] AS request,
                          o_orderkey // 500 AS page, count(*) AS n,
                          o_orderpriority = '5-LOW' AS cut
                   FROM orders GROUP BY ALL),
             t AS (SELECT request, sum(n)::BIGINT AS announced, max(page) AS last_page FROM p GROUP BY 1),
             r AS (SELECT * FROM p JOIN t USING (request) WHERE NOT (cut AND page = last_page))
        SELECT request, count(*) AS n_pages, sum(n)::BIGINT AS n_rows,
               max(announced) AS n_announced, count(*) FILTER (page = last_page) AS n_last_pages,
               sum(n) = max(announced) AND count(*) FILTER (page = last_page) = 1 AS complete
        FROM r GROUP BY 1""",
)
def page_completeness(spark, folder):
    """The last page of one request is lost and must be noticed."""
    read = pages.read_pages(spark, land_filings(spark, folder), KEY_ROW)
    lost = F.col("links.self").contains("form_type=5") & F.col("links.next").isNull()
    return pages.page_completeness(read.where(~lost))


@query(
    "page_gaps",
    f"""WITH p AS (SELECT '{BASE}?form_type=' || o_orderpriority[1] AS request,
                          (o_orderkey // 500) * 500 AS low, count(*) AS n
                   FROM orders GROUP BY ALL),
             t AS (SELECT request, sum(n)::BIGINT AS announced FROM p GROUP BY 1),
             r AS (SELECT request, low, low + n AS high, announced, 2 AS copies FROM p JOIN t USING (request)
                   WHERE request LIKE '%=2' AND low % 1500 = 0
                   UNION ALL
                   SELECT request, low, low + n, announced, 1 FROM p JOIN t USING (request)
                   WHERE NOT (request LIKE '%=2' AND low % 1500 = 0)
                     AND NOT (request LIKE '%=4' AND low % 1000 = 0)),
             s AS (SELECT *, coalesce(max(high) OVER (PARTITION BY request ORDER BY low
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM r),
             e AS (SELECT request, max(announced) AS announced, max(high) AS high FROM r GROUP BY 1)
        SELECT request, 'missing' AS kind, reached AS low, least(low, announced) AS high
        FROM s WHERE least(low, announced) > reached
        UNION ALL SELECT request, 'missing', high, announced FROM e WHERE announced > high
        UNION ALL SELECT request, 'doubled', low, high FROM s WHERE copies = 2
        UNION ALL SELECT request, 'beyond', greatest(low, announced), high FROM s WHERE high > announced""",
)
def page_gaps(spark, folder):
    """Pages of one request come twice, some of another are lost; offsets leave gaps by themselves."""
    read = pages.read_pages(spark, land_filings(spark, folder), KEY_ROW)
    offset, request = pages.page_offset(), pages.page_request()
    lost = request.endswith("=4") & (offset % 1000 == 0)
    twice = read.where(request.endswith("=2") & (offset % 1500 == 0))
    return pages.page_gaps(read.where(~lost).unionByName(twice))


TABLE_ROWS = {"metadata": FILING_ROW, "information_table": LINE_ROW}


def land_table(spark, folder, name) -> str:
    """Multi-table pages that hold one of the tables."""
    source = {"metadata": tables.filings, "information_table": tables.holding_lines}[name]
    landed = paged_by_row(source(spark, folder), F.lit(f"{BASE}?table=all"), name)
    return written_once(spark, f"{name}-pages", folder, lambda path: files.write_page_texts(landed, path))


@query("table_merge_metadata", f"SELECT {_FILING_SQL} FROM orders")
def table_merge_metadata(spark, folder):
    return pages.read_tables(spark, land_table(spark, folder, "metadata"), TABLE_ROWS)["metadata"]


@query(
    "table_merge_lines",
    """SELECT l_orderkey AS uuid, l_partkey AS cusip, l_linenumber AS line, l_quantity AS quantity,
              l_returnflag AS put_call, l_linestatus AS line_status,
              l_shipdate AS form_availability_timestamp FROM lineitem""",
)
def table_merge_lines(spark, folder):
    """Two page sets, of which one lacks the table."""
    payloads = [
        pages.read_tables(spark, land_table(spark, folder, name), TABLE_ROWS) for name in TABLE_ROWS
    ]
    return pages.merge_tables(payloads)["information_table"]


def bodies(spark, folder):
    """Event bodies as text; those of errors are cut off."""
    cut = F.col("event_type") == "error"
    body = F.when(cut, F.regexp_replace("props", r"\}$", "")).otherwise(F.col("props"))
    return read_table(spark, folder, "events").select("event_id", body.alias("value"))


@query(
    "row_list_frame",
    """SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events WHERE event_type <> 'error'""",
)
def row_list_frame(spark, folder):
    return pages.parse_rows(bodies(spark, folder), schemas.struct(k=schemas.LONG))[0]


@query(
    "row_list_rejects",
    """SELECT event_id, regexp_replace(props, '\\}$', '') AS value FROM events
       WHERE event_type = 'error'""",
)
def row_list_rejects(spark, folder):
    return pages.parse_rows(bodies(spark, folder), schemas.struct(k=schemas.LONG))[1]


@query(
    "ragged_json",
    """WITH d AS (SELECT event_id // 500 AS p, list(event_id ORDER BY event_id) AS a,
                         list(user_id * 1000000000 + event_id ORDER BY user_id, event_id)
                           FILTER (event_type = 'click') AS b
                  FROM events GROUP BY 1)
       SELECT unnest(a) AS event_id, unnest(b) AS clicked FROM d""",
)
def ragged_json(spark, folder):
    """Column-wise documents of 500 events, with a shorter second column."""
    events = read_table(spark, folder, "events")
    code = F.col("user_id") * 1_000_000_000 + F.col("event_id")
    clicked = F.when(F.col("event_type") == "click", code)
    documents = events.groupBy(by_key("event_id").alias("page")).agg(
        F.sort_array(F.collect_list("event_id")).alias("event_id"),
        F.sort_array(F.collect_list(clicked)).alias("clicked"),
    )
    path = written_once(
        spark, "ragged", folder, lambda path: files.write_json(documents.drop("page"), path)
    )
    return files.read_ragged_columns(
        spark, path, schemas.struct(event_id=schemas.LONGS, clicked=schemas.LONGS)
    )


@query("universe_scan", "SELECT DISTINCT o_custkey AS cik FROM orders")
def universe_scan(spark, folder):
    path = shared_folder(spark, "universe")
    filers = tables.filings(spark, folder).select(F.col("cik").cast("string")).distinct()
    files.write_text(filers, path)
    return files.read_universe(spark, path)


@query("json_roundtrip", f"SELECT {_FILING_SQL} FROM orders")
def json_roundtrip(spark, folder):
    path = shared_folder(spark, "json")
    files.write_json(tables.filings(spark, folder), path)
    return files.read_json(spark, path, FILING_ROW)


@query(
    "text_roundtrip",
    """SELECT line, count(*) AS n_rows FROM
         (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
)
def text_roundtrip(spark, folder):
    """Lines of one language written, those of the others appended, all gzipped."""
    path = shared_folder(spark, "text")
    lines = read_table(spark, folder, "documents").select(
        "lang", F.explode(F.split("text", "\n")).alias("value")
    )
    english = F.col("lang").eqNullSafe("en")
    files.write_text(lines.where(english).select("value"), path, gzip=True)
    files.write_text(lines.where(~english).select("value"), path, gzip=True, append=True)
    read = files.read_text(spark, path)
    return read.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n_rows"))


@query(
    "file_selection",
    """SELECT o_orderkey AS uuid, o_orderstatus AS status FROM orders
       WHERE o_orderstatus IN ('F', 'O')""",
)
def file_selection(spark, folder):
    """JSON files in a tree of folders, chosen by name and path; text files lie between."""
    root = shared_folder(spark, "tree")
    filings = tables.filings(spark, folder).select("uuid", "status")
    filings.write.partitionBy("status").json(f"{root}/json")
    filings.select(F.col("uuid").cast("string")).write.text(f"{root}/text")
    found = files.select_files(
        spark, root, "*.json", schemas.struct(uuid=schemas.LONG), regex="status=[FO]/"
    )
    origin = F.regexp_extract("file_path", "status=([A-Z])/", 1)
    return found.select("uuid", origin.alias("status"))


# Incremental sync.


@query(
    "incremental_since",
    """SELECT event_id, ts, user_id FROM events
       WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'error'
                   AND ts < TIMESTAMP '2024-01-20')""",
)
def incremental_since(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    loaded = events.where("event_type = 'error' AND ts < timestamp_ntz'2024-01-20'")
    return sync.rows_since(events, "ts", sync.high_water(loaded, "ts")).drop("event_type")


@query(
    "incremental_ties",
    """WITH drop1 AS (SELECT * FROM orders
                      WHERE o_orderstatus <> 'O' AND o_orderdate < TIMESTAMP '1997-01-01'),
            mark AS (SELECT max(o_orderdate) AS instant FROM drop1)
       SELECT o_orderkey AS uuid, o_orderdate AS filing_date, 0 AS load FROM drop1
       UNION ALL
       SELECT o_orderkey, o_orderdate, 1 FROM orders, mark
       WHERE o_orderdate > instant
          OR (o_orderdate = instant AND o_orderkey NOT IN (SELECT o_orderkey FROM drop1))""",
)
def incremental_ties(spark, folder):
    """Filings in three loads by a mark that knows its ties: what the first drop held, what the whole
    table holds beyond that, also at the mark's instant, and nothing when it is loaded again."""
    target = shared_folder(spark, "loads")
    filings = tables.filings(spark, folder).select("uuid", "filing_date", "status")
    drop = filings.where("status <> 'O' AND filing_date < timestamp_ntz'1997-01-01'")
    loads = [marks.load_once(rows, "filing_date", ["uuid"], target) for rows in (drop, filings, filings)]
    found = [
        marks.read_load(spark, target, filings.schema, n).withColumn("load", F.lit(n)) for n in loads
    ]
    return reduce(DataFrame.unionByName, found).drop("status")


@query(
    "late_knowledge",
    """SELECT l_orderkey AS uuid, o_orderdate AS filing_date,
              l_shipdate AS form_availability_timestamp, l_linenumber AS line
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
         AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def late_knowledge(spark, folder):
    """Lines known in 1998 about filings of earlier years."""
    known = date_window(
        tables.holding_lines(spark, folder).select("uuid", "line", "form_availability_timestamp"),
        start_datetime="1998-01-01T00:00:00+00:00",
        end_datetime="1999-01-01T00:00:00+00:00",
        date_mode="knowledge_date",
    )
    dated = known.join(tables.filings(spark, folder).select("uuid", "filing_date"), "uuid")
    return sync.late_rows(dated, "filing_date", F.lit("1998-01-01").cast("timestamp_ntz"))


def land_drops(spark, folder, root) -> None:
    """Two drops of pages that overlap. The second has older rows too; its pages of one item are
    pretty-printed, one a file, and among them lie error bodies and cut-off pages."""
    facts = tables.item_facts(spark, folder).select(*FACT_ROW.names)

    def page_texts(items, name):
        rows = facts.where(F.col("item_name").isin(items))
        return paged_by_row(rows, F.lit(f"{BASE}?drop={name}"))

    files.write_page_texts(page_texts(["purchase", "signup", "view"], "first"), f"{root}/first/lines")
    files.write_page_texts(page_texts(["view", "error"], "second"), f"{root}/second/lines")
    form = {"pretty": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    clicks = by_row(facts.where("item_name = 'click'"))
    pretty = paged(clicks, F.col(PAGE), F.lit(f"{BASE}?drop=third")).select(
        F.to_json(F.struct("links", "count", "data"), form).alias("value")
    )
    pretty.write.option("maxRecordsPerFile", 1).text(f"{root}/second/pretty")
    message = F.format_string('{"message": "nothing on %s"}', F.to_date("filing_date").cast("string"))
    dated = tables.item_facts(spark, folder).select(message.alias("value")).distinct()
    cut = facts.select(F.format_string('{"links": {"self": "%s', "item_name").alias("value"))
    dated.unionByName(cut.distinct()).write.text(f"{root}/second/bad")


def synced(spark, folder) -> str:
    """The first drop synced by one feed, then both drops by another, which knows nothing of it."""
    drops = written_once(spark, "drops", folder, lambda path: land_drops(spark, folder, path))
    root = shared_folder(spark, "sync")
    for landing, feed in ((f"{drops}/first", "a"), (drops, "b")):
        sync.sync_pages(
            spark,
            landing=landing,
            target=f"{root}/target",
            checkpoint=f"{root}/{feed}",
            row=FACT_ROW,
            key=["form_uuid", "item_name"],
            knowledge="form_availability_timestamp",
        )
    return f"{root}/target"


@query(
    "stream_sync",
    """SELECT event_id AS form_uuid, user_id AS cik, event_type AS item_name, value AS item_value,
              ts AS form_availability_timestamp FROM events""",
)
def stream_sync(spark, folder):
    return sync.read_target(spark, synced(spark, folder), FACT_ROW)


@query(
    "stream_sync_rejects",
    """SELECT DISTINCT '{"message": "nothing on ' || ts::DATE || '"}' AS value FROM events
       UNION ALL SELECT DISTINCT '{"links": {"self": "' || event_type FROM events""",
)
def stream_sync_rejects(spark, folder):
    """Pages no row could be read from, each once."""
    return sync.read_rejects(spark, synced(spark, folder)).select("value")


@query(
    "stream_sync_restated",
    """SELECT event_id AS form_uuid, count(DISTINCT value) AS n_values, min(ts) AS first_known,
              max(ts) AS last_known,
              max_by(value, ts) AS last_value
       FROM (SELECT event_id, value, ts FROM events
             UNION ALL SELECT event_id, value + 1, ts + INTERVAL 400 DAY FROM events
             WHERE event_type = 'purchase') GROUP BY event_id""",
)
def stream_sync_restated(spark, folder):
    """Facts of one kind are restated later with another value; both versions stay."""
    facts = tables.item_facts(spark, folder).select(*FACT_ROW.names)
    later = facts.where("item_name = 'purchase'").withColumns(
        {
            "item_value": F.col("item_value") + 1,
            "form_availability_timestamp": F.col("form_availability_timestamp") + F.expr("INTERVAL 400 DAY"),
        }
    )

    def land(path):
        for name, rows in (("first", facts), ("later", later), ("again", facts.where("form_uuid % 3 = 0"))):
            files.write_page_texts(paged_by_row(rows, F.lit(f"{BASE}?drop={name}")), f"{path}/{name}")

    drops = written_once(spark, "restated", folder, land)
    root = shared_folder(spark, "sync-restated")
    for name in ("first", "later", "again"):
        sync.sync_pages(
            spark,
            landing=f"{drops}/{name}",
            target=f"{root}/target",
            checkpoint=f"{root}/{name}",
            row=FACT_ROW,
            key=["form_uuid", "item_name"],
            knowledge="form_availability_timestamp",
        )
    rows = sync.read_target(spark, f"{root}/target", FACT_ROW)
    known = "form_availability_timestamp"
    return rows.groupBy("form_uuid").agg(
        F.count_distinct("item_value").alias("n_values"),
        F.min(known).alias("first_known"),
        F.max(known).alias("last_known"),
        F.max_by("item_value", known).alias("last_value"),
    )


SYNCED = {
    "metadata": sync.SyncedTable(FILING_ROW, ("uuid",), "filing_date"),
    "information_table": sync.SyncedTable(LINE_ROW, ("uuid", "line", "cusip"), "form_availability_timestamp"),
}


@query(
    "stream_sync_tables",
    """SELECT 'metadata' AS name, o_orderkey AS uuid, count(*) AS n_rows FROM orders GROUP BY 2
       UNION ALL SELECT 'information_table', l_orderkey, count(*) FROM
         (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY 2""",
)
def stream_sync_tables(spark, folder):
    """Multi-table pages, each with one of two tables, synced into two targets; keys as last known."""
    root = shared_folder(spark, "sync-tables")
    targets = {name: f"{root}/{name}" for name in SYNCED}
    for name in SYNCED:
        sync.sync_tables(
            spark,
            land_table(spark, folder, name),
            targets,
            f"{root}/{name}-checkpoint",
            SYNCED,
            f"{root}/rejects",
            schemas.table_envelope({n: t.row for n, t in SYNCED.items()}),
        )
    counted = [
        versions.latest(sync.read_target(spark, targets[name], kept.row), list(kept.key), kept.knowledge)
        .groupBy("uuid")
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("name"), "uuid", "n_rows")
        for name, kept in SYNCED.items()
    ]
    return counted[0].unionByName(counted[1])
