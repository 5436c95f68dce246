"""Composed filing queries: headers, insider forms, items, documents, holdings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import guards, schemas
from tidemark.operators.ids import filter_filers, filter_form_types, filter_ids, filter_item
from tidemark.operators.joins import member_rows
from tidemark.operators.windows import date_window
from tidemark.session import stored

HEADER_ORDER = ["filing_date", "cik", "uuid"]
ITEM_ORDER = ["filing_date", "cik", "item_name", "form_uuid"]
HOLDING_ORDER = ["uuid", "cusip"]


def select_filings(
    filings: DataFrame,
    form_type=None,
    cik=None,
    start_datetime=None,
    end_datetime=None,
    date_mode=None,
    valid_types=None,
    unique_ids: bool = False,
    knowledge: str = "form_availability_timestamp",
) -> DataFrame:
    """Conjunctive filter over a table with one row per filing.

    `unique_ids` states that a DataFrame given as `cik` holds each filer once.
    """
    filings = filter_form_types(filings, form_type, valid_types)
    filings = date_window(filings, start_datetime, end_datetime, date_mode, knowledge=knowledge)
    return filter_filers(filings, cik, unique=unique_ids)


def form_headers(headers: DataFrame, ordered: bool = True, **filters) -> DataFrame:
    """Headers of the asked forms and filers in the asked window, in filing order."""
    filters.setdefault("knowledge", "header_availability_timestamp")
    chosen = select_filings(headers, **filters)
    return chosen.orderBy(*HEADER_ORDER) if ordered else chosen


def _link(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns that tie rows of one filing: its uuid, and the layout of both tables."""
    layout = (schemas.FAMILY, schemas.FILING_MONTH)
    return ["uuid", *[c for c in layout if c in left.columns and c in right.columns]]


def children_of(parent: DataFrame, child: DataFrame) -> DataFrame:
    """Child rows of the chosen filings; `parent` has one row per uuid.

    Where both are stored by family and month, these join too, so that the window of
    the parent prunes the scan of the child.
    """
    return member_rows(child, parent, _link(parent, child), unique=True)


def parents_of(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Filings that have a row in `child`; `parent` has one row per uuid."""
    return member_rows(parent, child, _link(parent, child), one_row_per_key=True)


def payload_tables(
    tables: dict[str, DataFrame], parent: DataFrame, keep_parent: bool = False
) -> dict[str, DataFrame]:
    """All tables of a payload cut to the filings in `parent`; no key is ever absent.

    `keep_parent` writes the chosen filings to the checkpoint folder once, for
    callers who go on to read every table and whose filter is dear.
    """
    if keep_parent:
        parent = stored(parent)
    return {
        name: parent if name == "metadata" else children_of(parent, table)
        for name, table in tables.items()
    }


def insider_payload(
    tables: dict[str, DataFrame], keep_parent: bool = False, **filters
) -> dict[str, DataFrame]:
    """Forms 3, 4, 5 and their amendments: six tables of the chosen filings."""
    filters.setdefault("form_type", schemas.FORM_FAMILIES["form4"])
    return payload_tables(tables, select_filings(tables["metadata"], **filters), keep_parent)


def item_payload(
    items: DataFrame,
    cik=None,
    start_datetime=None,
    end_datetime=None,
    date_mode=None,
    item: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Item facts, sorted when all sort columns are there."""
    items = date_window(filter_item(items, item), start_datetime, end_datetime, date_mode)
    items = filter_filers(items, cik)
    order = [c for c in ITEM_ORDER if c in items.columns]
    sortable = set(ITEM_ORDER[:3]) <= set(order)
    return items.orderBy(*order) if ordered and sortable else items


def document_payload(documents: DataFrame, **filters) -> DataFrame:
    """Documents with their variant body, by the same filters as headers."""
    return select_filings(documents, **filters)


def document_by_uuid(documents: DataFrame, uuid) -> DataFrame:
    """One document, a list of them, or those named by a table of ids."""
    return filter_ids(documents, "uuid", uuid)


def holdings_payload(
    tables: dict[str, DataFrame],
    cik=None,
    cusip=None,
    unique_ids: bool = False,
    keep_parent: bool = False,
    **filters,
) -> dict[str, DataFrame]:
    """Holdings reports by filer, or the holdings of given securities in any report.

    `unique_ids` states that a DataFrame of filers or securities holds each id once;
    `keep_parent` is that of `payload_tables`. Lines that carry their filing day are cut to a
    window of publication before the reports are looked up, which prunes a table stored by month.
    """
    guards.check_exclusive(cik=cik, cusip=cusip)
    filters.setdefault("form_type", schemas.FORM_FAMILIES["form13"])
    parent = select_filings(tables["metadata"], cik=cik, unique_ids=unique_ids, **filters)
    if cusip is None:
        return payload_tables(tables, parent, keep_parent)
    lines = filter_ids(tables["information_table"], "cusip", cusip, unique_ids)
    if filters.get("date_mode") == "publication_date" and "filing_date" in lines.columns:
        window = ("start_datetime", "end_datetime", "date_mode")
        lines = date_window(lines, **{k: filters.get(k) for k in window})
    holders = parents_of(lines, parent)
    if keep_parent:
        holders = stored(holders)
    held = {"metadata": holders, "information_table": children_of(parent, lines)}
    return {
        name: held[name] if name in held else children_of(holders, table)
        for name, table in tables.items()
    }


def ordered_holdings(lines: DataFrame) -> DataFrame:
    """Lines by filing and security. The other columns break ties, which lets the
    range partitioning of the sort cut a filing with very many equal keys."""
    return lines.orderBy(*HOLDING_ORDER, *[c for c in lines.columns if c not in HOLDING_ORDER])


def resolve_footnotes(
    rows: DataFrame, footnotes: DataFrame, row_key: list[str], text: str = "footnote"
) -> DataFrame:
    """Row key with the texts of its footnote list, in list order.

    A list entry is looked up by (uuid, footnote_id); a row's texts are gathered
    again by its own key, so a group is as long as that row's list. An empty list
    gives an empty array, a missing list NULL.
    """
    kept = dict.fromkeys([*row_key, "uuid", "footnote_ids"])
    listed = rows.select(*kept, F.posexplode_outer("footnote_ids").alias("pos", "footnote_id"))
    notes = footnotes.select("uuid", "footnote_id", F.col(text).alias("_text"))
    found = listed.join(notes, ["uuid", "footnote_id"], "left")
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "_text"))
    texts = F.transform(F.array_sort(F.collect_list(entry)), lambda n: n["_text"])
    return found.groupBy(*row_key).agg(
        F.when(F.bool_or(F.col("footnote_ids").isNotNull()), texts).alias("footnotes")
    )


def describe_items(facts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Item facts with the description of their item, NULL for an unknown item."""
    return facts.join(
        dictionary.select(F.col("item").alias("item_name"), "description"), "item_name", "left"
    )


def flatten_meta(documents: DataFrame, fields: dict[str, str], meta: str = "meta") -> DataFrame:
    """Column-oriented meta `{"cik": {"0": 1}}` in a variant column to flat columns."""
    flat = {
        name: F.try_variant_get(F.col(meta), f'$.{name}["0"]', dtype)
        for name, dtype in fields.items()
    }
    return documents.withColumns(flat).drop(meta)


def document_path(body, path: str, dtype: str = "variant") -> Column:
    """Subtree or value at a JSON path of a variant body; NULL where absent."""
    return F.try_variant_get(F.col(body) if isinstance(body, str) else body, path, dtype)


def document_nodes(documents: DataFrame, body: str, path: str) -> DataFrame:
    """One row per child of the node at `path`: position, key (objects only), value."""
    spark = documents.sparkSession
    nodes = documents.withColumn("_node", document_path(body, path))
    view = nodes.drop(body)
    return spark.sql(
        "SELECT d.* EXCEPT (_node), v.pos, v.key, v.value"
        " FROM {docs} d, LATERAL variant_explode(d._node) v",
        docs=view,
    )
