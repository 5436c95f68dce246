"""Declared schemas of the lake tables and the fixed lists the queries accept.

Nothing is inferred: historical and live vintages of one table differ in type,
so every reader takes its schema from here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Form types by family, date modes, catalog facets.
FORM_FAMILIES = {
    "form4": ["3", "3/A", "4", "4/A", "5", "5/A"],
    "form8": ["8-K", "8-K/A"],
    "form10": ["10-K", "10-K/A", "10-Q", "10-Q/A"],
    "form13": ["13F-HR", "13F-HR/A"],
}
FORM_TYPES = [form for family in FORM_FAMILIES.values() for form in family]
DATE_MODES = ["publication_date", "knowledge_date"]
FACETS = {
    "COMMODITIES": "commodity",
    "BUSINESS-CATEGORIES": "business_category",
    "COUNTRIES": "country",
    "FREQUENCIES": "frequency",
}
# Partition columns of the stored filing tables; filters use them when present.
FAMILY = "family"
FILING_MONTH = "filing_month"
INSIDER_TABLES = [
    "metadata",
    "derivative_table",
    "footnotes",
    "general_info",
    "non_derivative_table",
    "reporting_owner_info",
]


STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BOOL, DAY, INSTANT, ZONELESS = (
    T.BooleanType(),
    T.DateType(),
    T.TimestampType(),
    T.TimestampNTZType(),
)
INTS, LONGS, STRINGS = T.ArrayType(INT), T.ArrayType(LONG), T.ArrayType(STRING)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


HEADERS = struct(
    uuid=STRING,
    cik=LONG,
    filing_date=DAY,
    form_type=STRING,
    edgar_path=STRING,
    company=STRING,
    acceptance_datetime=INSTANT,
    period_of_report=DAY,
    header_availability_timestamp=INSTANT,
)
FORM8_ITEMS = struct(
    form_uuid=STRING,
    filing_url=STRING,
    form_publication_timestamp=INSTANT,
    filing_date=DAY,
    is_real_time=BOOL,
    rt_form_processing_timestamp=INSTANT,
    cik=LONG,
    ticker=STRING,
    item_name=STRING,
    form_table_row_name=STRING,
    item_value=DOUBLE,
    compustat_timestamp=INSTANT,
    period_of_report=DAY,
    compustat_coifnd_id=LONG,
    form_availability_timestamp=INSTANT,
    gvk=LONG,
)
# The insider tables keep only the columns the public outputs show; readers
# append further columns with `unionByName(allowMissingColumns=True)`.
FILING_METADATA = struct(
    uuid=STRING,
    cik=LONG,
    form_type=STRING,
    filing_date=DAY,
    form_availability_timestamp=INSTANT,
)
# Child tables carry the filing day of their filing, by which they are stored.
FOOTNOTES = struct(uuid=STRING, filing_date=DAY, footnote_id=STRING, footnote=STRING)
INSIDER_CHILD = struct(uuid=STRING, filing_date=DAY, footnote_ids=STRINGS)
HOLDING_HEADER = struct(uuid=STRING, filing_date=DAY, cik=LONG)
INFORMATION_TABLE = struct(
    uuid=STRING,
    filing_date=DAY,
    cusip=STRING,
    investment_discretion=STRING,
    name_of_issuer=STRING,
    other_manager=INTS,
    put_call=STRING,
    ssh_prnamt=LONG,
    ssh_prnamt_type=STRING,
    title_of_class=STRING,
    value=LONG,
    voting_authority_none=LONG,
    voting_authority_shared=LONG,
    voting_authority_sole=LONG,
)
INSIDER = {
    name: {"metadata": FILING_METADATA, "footnotes": FOOTNOTES}.get(name, INSIDER_CHILD)
    for name in INSIDER_TABLES
}
HOLDINGS = {
    "metadata": FILING_METADATA,
    "header_data": HOLDING_HEADER,
    "information_table": INFORMATION_TABLE,
}
DOCUMENTS = struct(
    uuid=STRING,
    cik=LONG,
    filing_date=DAY,
    form_type=STRING,
    form_availability_timestamp=INSTANT,
    is_real_time=BOOL,
    data=T.VariantType(),
)
ID_MAP = struct(cik=STRING, effdate=ZONELESS, thrudate=ZONELESS, gvk=STRING)
ITEMS = struct(item=STRING, description=STRING)
CATALOG = struct(
    name=STRING,
    commodity=STRING,
    payload_id=STRING,
    business_category=STRING,
    country=STRING,
    frequency=STRING,
    unit=STRING,
    start_date=STRING,
)
SERIES_VALUES = struct(
    payload_id=STRING,
    original_period=STRING,
    original_value=STRING,
    value=DOUBLE,
)


def envelope(row: T.DataType) -> T.StructType:
    """Schema of one landed response page whose `data` is a list of `row`."""
    return _page(T.ArrayType(row))


def table_envelope(tables: dict[str, T.StructType]) -> T.StructType:
    """Schema of one landed page whose `data` maps table names to row lists."""
    return _page(
        T.StructType([T.StructField(name, T.ArrayType(row)) for name, row in tables.items()])
    )


def _page(data: T.DataType) -> T.StructType:
    links = struct(self=STRING, first=STRING, last=STRING, next=STRING)
    return T.StructType(
        [
            T.StructField("links", links),
            T.StructField("count", T.LongType()),
            T.StructField("data", data),
        ]
    )

