"""Null tokens, typed casts and schema conforming, all native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKEN = "NA"
# Texts of these shapes are cast, others are NULL at once: a failing cast costs as
# much as fifty good ones, and raw columns can hold many unreadable values.
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
NUMBER_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE_TEXT = r"^\s*([+-]?\d+)(?:\.0*)?\s*$"
POWER_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)[eE][+-]?\d+\s*$"
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"


def _column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def pad_key(column, width: int) -> Column:
    """Integer key as a zero-padded string; longer keys stay whole."""
    text = _column(column).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def unpad_key(column) -> Column:
    return _readable(_column(column), "bigint")


def clean_token(column, empty_too: bool = False) -> Column:
    """`NA` to NULL; with `empty_too`, as for number columns, blanks as well."""
    c = F.nullif(_column(column), F.lit(NULL_TOKEN))
    return F.when(F.trim(c) != "", c) if empty_too else c


def typed(column, dtype: str, strict: bool = False) -> Column:
    """Cleaned text as `dtype`; an unreadable value is NULL, or an error if strict."""
    if strict or dtype == "string":
        return clean_token(column, empty_too=dtype != "string").cast(dtype)
    # Null tokens are unreadable too.
    return _readable(_column(column), dtype)


def _readable(text: Column, dtype: str) -> Column:
    if dtype in ("int", "bigint"):
        return F.when(text.rlike(INTEGER_TEXT), text.try_cast(dtype))
    if dtype in ("float", "double") or dtype.startswith("decimal"):
        return F.when(text.rlike(NUMBER_TEXT), text.try_cast(dtype))
    return text.try_cast(dtype)


def typed_columns(df: DataFrame, casts: dict[str, str], strict: bool = False) -> DataFrame:
    """The listed columns cleaned and cast; in all other text columns `NA` is NULL too."""
    others = {
        f.name: clean_token(f.name)
        for f in df.schema
        if f.name not in casts and isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(
        others | {name: typed(name, dtype, strict) for name, dtype in casts.items()}
    )


def cast_failures(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Per column, how many values are present but unreadable as the target type."""
    counts = [
        F.count_if(
            clean_token(name, empty_too=dtype != "string").isNotNull() & typed(name, dtype).isNull()
        ).alias(name)
        for name, dtype in casts.items()
    ]
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_failed")) for name in casts
    ]
    return df.agg(*counts).select(F.inline(F.array(*pairs)))


def integer(column, dtype: str = "bigint") -> Column:
    """`1091`, `"1091.0"`, `"1.091E3"` as a whole number, without passing through double; a number
    with a fraction is unreadable, so NULL."""
    text = _column(column).cast("string")
    plain = F.nullif(F.regexp_extract(text, WHOLE_TEXT, 1), F.lit(""))
    return F.coalesce(plain, _power(text)).try_cast(dtype)


def _power(text: Column) -> Column:
    power = F.when(text.rlike(POWER_TEXT), text.try_cast("decimal(38,10)"))
    return F.when(power == F.round(power), power).cast("decimal(28,0)").cast("string")


def integer_list(column) -> Column:
    """`"(2, 3)"`, `"(4,)"`, `"[1, 2]"` to an int array; blank to NULL."""
    inner = F.translate(_column(column), "()[] \t\n\x0b\f\r", "")
    parts = F.split(F.regexp_replace(inner, ",$", ""), ",")
    return F.when(inner != "", parts.try_cast("array<int>"))


def text_list(column) -> Column:
    """`"F1, F2"`, `"['F1', 'F2']"` to an array of texts; blank to NULL. An entry that holds a comma
    cannot be told from two."""
    inner = F.regexp_replace(_column(column), r"^\s*[(\[]|[)\]]\s*$", "")

    def read(inner: Column) -> Column:
        entries = F.split(F.regexp_replace(inner, r",\s*$", ""), r"\s*,\s*")
        bare = F.transform(entries, lambda e: F.regexp_replace(F.trim(e), "^(['\"])(.*)\\1$", "$2"))
        return F.when(F.trim(inner) != "", bare)

    return F.get(F.transform(F.array(inner), read), F.lit(0))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Any vintage of a table in its declared schema: absent columns are NULL,
    number, list and document texts are read, `NA` and blanks in text columns are NULL."""
    read, columns = _conformed(df, schema)
    return read.select(*[columns[name].alias(name) for name in schema.names])


def _conformed(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, dict[str, Column]]:
    """The frame with its values read as declared beside its own columns, and where each is found.

    All whole numbers of a row are read by one expression over their array: an expression each, with
    its patterns, makes a projection of many columns too long for the JVM to compile, many times slower.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    whole: dict[str, list[str]] = {}
    read, columns = {}, {}
    for field in schema.fields:
        name, want, had = field.name, field.dataType, found.get(field.name, T.NullType())
        if isinstance(want, T.IntegralType) and had != want and not isinstance(had, T.NullType):
            listed = whole.setdefault(want.simpleString(), [])
            columns[name] = F.get(f"_whole_{want.simpleString()}", F.lit(len(listed)))
            listed.append(name)
        else:
            read[f"_read_{name}"] = _conform(field, found.get(name))
            columns[name] = F.col(f"_read_{name}")
    for dtype, names in whole.items():
        read[f"_whole_{dtype}"] = _integers(F.array(*[F.col(n).cast("string") for n in names]), dtype)
    return df.select("*", *[c.alias(name) for name, c in read.items()]), columns


def _integers(texts: Column, dtype: str) -> Column:
    """`integer` of each text of an array."""
    plain = F.transform(
        texts,
        lambda t: F.struct(t.alias("text"), F.regexp_extract(t, WHOLE_TEXT, 1).alias("plain")),
    )
    return F.transform(
        plain,
        lambda t: F.when(t["plain"] != "", t["plain"].try_cast(dtype)).otherwise(
            _power(t["text"]).try_cast(dtype)
        ),
    )


def _conform(field: T.StructField, found: T.DataType | None) -> Column:
    want, c = field.dataType, F.col(field.name)
    if found is None or isinstance(found, T.NullType):
        return F.lit(None).cast(want)
    if found == want and not isinstance(want, T.StringType):
        return c
    if isinstance(want, T.IntegralType):
        return integer(c, want.simpleString())
    if isinstance(want, T.ArrayType):
        if isinstance(found, T.ArrayType):
            return c.cast(want)
        read = text_list if isinstance(want.elementType, T.StringType) else integer_list
        return read(clean_token(c))
    if isinstance(want, T.VariantType) and isinstance(found, T.StringType):
        return F.try_parse_json(clean_token(c, empty_too=True))
    if isinstance(want, T.StringType):
        text = F.trim(c.cast("string"))
        return F.when(~text.isin(NULL_TOKEN, ""), text)
    return c.try_cast(want)


def conform_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per declared column that a vintage has: how many values it holds that do not read as the
    declared type. Blanks, `NA` and NaN are no values."""
    read, columns = _conformed(df, schema)
    lost = _lost(df, schema, columns)
    counts = [F.count_if(failed).alias(name) for name, failed in lost.items()]
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_failed")) for name in lost
    ]
    return read.agg(*counts).select(F.inline(F.array(*pairs)))


# Texts that are no values, whatever the declared type.
NO_VALUE = ("", NULL_TOKEN, "NaN")


def _lost(df: DataFrame, schema: T.StructType, conformed: dict[str, Column]) -> dict[str, Column]:
    """Per declared column that a vintage has: whether a value does not read as the declared type."""
    found = {f.name: f.dataType for f in df.schema.fields}
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    lost = {}
    for field in [f for f in schema.fields if f.name in found]:
        held, had = F.col(field.name), found[field.name]
        if had == field.dataType or isinstance(field.dataType, T.StringType) and not isinstance(had, nested):
            # Read as it is, or as a text, which any value has.
            lost[field.name] = F.lit(False)
            continue
        if isinstance(had, nested):
            present = held.isNotNull()
        else:
            present = F.coalesce(~F.trim(held.cast("string")).isin(*NO_VALUE), F.lit(False))
        lost[field.name] = conformed[field.name].isNull() & present
    return lost


VINTAGE, LOST = "_vintage", "_lost"


def conform_marked(vintages: list[DataFrame], schema: T.StructType) -> DataFrame:
    """`conform_union` with the number of the vintage, and the names of the columns whose value did not
    read, a line each, NULL where all did."""
    marked = []
    for k, df in enumerate(vintages):
        read, columns = _conformed(df, schema)
        names = [F.when(failed, F.lit(name)) for name, failed in _lost(df, schema, columns).items()]
        lost = F.concat_ws("\n", *names)
        marked.append(
            read.select(
                *[columns[name].alias(name) for name in schema.names],
                F.lit(k).alias(VINTAGE),
                F.nullif(lost, F.lit("")).alias(LOST),
            )
        )
    return reduce(DataFrame.unionByName, marked)


def marked_failures(marked: DataFrame) -> DataFrame:
    """(vintage, column_name, n_failed) of the columns of marked rows with values that did not read."""
    lines = F.explode(F.split(LOST, "\n"))
    names = marked.select(F.col(VINTAGE).alias("vintage"), lines.alias("column_name"))
    return names.groupBy("vintage", "column_name").agg(F.count("*").alias("n_failed"))


def conform_union(vintages: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Vintages conformed first and stacked second."""
    conformed = [conform(df, schema) for df in vintages]
    result = conformed[0]
    for df in conformed[1:]:
        result = result.unionByName(df)
    return result


def iso_conformance(df: DataFrame, *columns: str) -> DataFrame:
    """Per text column: does every value read as an ISO date-time, and how many do not."""
    pairs, aggs = [], []
    for name in columns:
        fits = F.col(name).rlike(ISO_DATETIME) & F.col(name).try_cast("timestamp").isNotNull()
        violates = F.col(name).isNotNull() & ~F.coalesce(fits, F.lit(False))
        aggs.append(F.count_if(violates).alias(name))
        pairs.append(
            F.struct(
                F.lit(name).alias("column_name"),
                (F.col(name) == 0).alias("conforms"),
                F.col(name).alias("n_violations"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*pairs)))
