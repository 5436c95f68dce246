"""Stored postings: which rows hold a term, laid out so that a search reads its terms only.

Terms are words (keyword search) or three-letter runs (substring search). Postings lie in
folders by a hash of the term and are sorted by term, so a search prunes folders and row groups. A
term that most rows hold spans several files, as rows are dealt by ranges of (term, key). Runs of
letters are many times as many as their rows, so a task lists the keys of its rows per run, and only
these lists are written, dealt and sorted.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tidemark.functions.keywords import query_tokens, tokens
from tidemark.operators.catalog import TEXT_COLUMNS
from tidemark.operators.joins import member_rows
from tidemark.session import discard, stored

BUCKETS = 64
BUCKET, TERM = "bucket", "term"
GRAM = 3
KEYS, LIST_KEYS = "keys", 1000
PIECE_BYTES = 1 << 20


def bucket_of(term: str, buckets: int) -> int:
    """The folder of a term; the same for a literal and, by `_bucket`, for a column."""
    return xxhash.xxh64_intdigest(term.encode(), seed=42) % (1 << 63) % buckets


def _bucket(term: Column, buckets: int) -> Column:
    positive = F.xxhash64(term).bitwiseAND(F.lit((1 << 63) - 1))
    return (positive % buckets).cast("int")


def _spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores: a small file of few row groups is scanned by few tasks, and its postings
    are many times as large."""
    context, conf = rows.sparkSession.sparkContext, rows.sparkSession.conf
    tasks = max(2 * context.defaultParallelism, int(conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, *rows.columns)


def _write(postings: DataFrame, key: list[str | Column], path: str, buckets: int) -> None:
    """Terms are made once and written: the ranges are drawn from what was written and dealt from it."""
    laid_out = stored(postings.withColumn(BUCKET, _bucket(F.col(TERM), buckets)))
    order = [BUCKET, TERM, *key]
    (
        laid_out.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    discard(laid_out)


def _read(spark: SparkSession, path: str, terms: list[str], buckets: int) -> DataFrame:
    places = sorted({bucket_of(t, buckets) for t in terms})
    return spark.read.parquet(path).where(F.col(BUCKET).isin(places) & F.col(TERM).isin(terms))


def write_keywords(
    rows: DataFrame, key: list[str], text: str, path: str, buckets: int = BUCKETS
) -> None:
    """Postings (term, key, n_tokens) of the distinct tokens of a text; rows without one have none."""
    held = _spread(rows.select(*key, text)).select(*key, tokens(text).alias("_tokens"))
    postings = held.select(
        *key,
        F.size("_tokens").cast("bigint").alias("n_tokens"),
        F.explode(F.array_distinct("_tokens")).alias(TERM),
    )
    _write(postings, key, path, buckets)


def search_keywords(
    spark: SparkSession, path: str, key: list[str], keywords, buckets: int = BUCKETS
) -> DataFrame:
    """Key, `score` (distinct tokens of the phrase held) and n_tokens of every row that holds a
    token: what `keyword_matches` finds, read from the postings of these tokens alone."""
    found = _read(spark, path, query_tokens(keywords), buckets)
    return found.groupBy(*key).agg(F.count("*").alias("score"), F.max("n_tokens").alias("n_tokens"))


def _haystack(rows: DataFrame, columns: list[str]) -> Column:
    present = [F.col(c) for c in columns if c in rows.columns]
    return F.lower(F.concat_ws(" ", *present))


def _lister(key: list[str], text: str):
    """Function of the Arrow batches of one task to lists of keys per three-letter run, at most
    `LIST_KEYS` each. A row is in the lists of a run once; a piece of about `PIECE_BYTES` of text,
    one row at least, is held at a time."""

    def pieces(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
            piece = np.cumsum(sizes) // PIECE_BYTES
            bounds = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
            for k, end in zip(bounds, bounds[1:]):
                rows = texts.slice(k, end - k).to_pylist()
                yield batch.slice(k, end - k).select(key), [(t or b"").decode("utf-8", "replace") for t in rows]

    def lists(batches):
        import numpy as np
        import pyarrow as pa

        def begins(*columns):
            return np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))

        for keys, texts in pieces(batches):
            points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
            row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
            whole = row[: 1 - GRAM] == row[GRAM - 1 :]
            if not whole.any():
                continue
            # A code point has 21 bits, so a run is one whole number.
            gram = (points[:-2] << 42 | points[1:-1] << 21 | points[2:])[whole]
            order = np.argsort(gram, kind="stable")
            gram, row = gram[order], row[: 1 - GRAM][whole][order]
            once = begins(gram, row)
            gram, row = gram[once], row[once]
            starts = np.flatnonzero(begins(gram))
            place = np.arange(len(gram)) - np.repeat(starts, np.diff(starts, append=len(gram)))
            cuts = np.flatnonzero(place % LIST_KEYS == 0)
            letters = gram[cuts, None] >> np.array([42, 21, 0]) & (1 << 21) - 1
            terms = letters.astype("<u4").tobytes().decode("utf-32-le")
            held = keys.take(pa.array(row)).to_struct_array()
            ends = pa.array(np.append(cuts, len(gram)), pa.int32())
            columns = [
                pa.array([terms[k : k + GRAM] for k in range(0, len(terms), GRAM)], pa.string()),
                pa.ListArray.from_arrays(ends, held),
            ]
            yield pa.RecordBatch.from_arrays(columns, [TERM, KEYS])

    return lists


def write_grams(
    rows: DataFrame,
    key: list[str],
    path: str,
    columns: list[str] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Postings (term, keys) of the three-letter runs of the searched columns, in lower case."""
    held = _spread(rows.select(*key, _haystack(rows, columns or TEXT_COLUMNS).alias("_text")))
    keys = ArrayType(StructType([held.schema[k] for k in key]))
    listed = held.mapInArrow(_lister(key, "_text"), StructType().add(TERM, StringType()).add(KEYS, keys))
    _write(listed, [F.col(KEYS)[0]], path, buckets)


def search_substring(
    rows: DataFrame,
    path: str,
    key: list[str],
    text: str,
    columns: list[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows whose searched columns hold a text, whatever its case.

    Rows that hold all its three-letter runs come from the postings; only these are looked up, and
    their columns decide. A shorter text has no run, so all rows are looked through.
    """
    needle = text.lower()
    holds = F.contains(_haystack(rows, columns or TEXT_COLUMNS), F.lit(needle))
    grams = sorted({needle[k : k + GRAM] for k in range(len(needle) - GRAM + 1)})
    if not grams:
        return rows.where(holds)
    lists = _read(rows.sparkSession, path, grams, buckets).select(F.explode(KEYS).alias("_key"))
    held = lists.select("_key.*").groupBy(*key).agg(F.count("*").alias("n"))
    keys = held.where(F.col("n") == len(grams)).select(*key)
    return member_rows(rows, keys, key, one_row_per_key=True).where(holds)
