"""Keyword search: OR over the query's tokens, rows holding most of them first."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\s-]+"


def query_tokens(keywords) -> list[str]:
    """Distinct lower-case tokens of a phrase or a list of phrases."""
    text = keywords if isinstance(keywords, str) else " ".join(keywords)
    tokens = {t for t in re.split(SEPARATORS, text.lower()) if t}
    if not tokens:
        raise ValueError("keywords hold no token")
    return sorted(tokens)


def tokens(column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.array_remove(F.split(F.lower(c), SEPARATORS), "")


def keyword_matches(df: DataFrame, text: str, keywords) -> DataFrame:
    """Rows holding a token, with `score` (distinct tokens held) and `n_tokens`.

    One regular expression drops the rows without any token before the texts
    of the rest are split.
    """
    wanted = query_tokens(keywords)
    any_token = "|".join(re.escape(t) for t in wanted)
    held = F.size(F.array_intersect(F.col("_tokens"), F.array(*[F.lit(t) for t in wanted])))
    return (
        df.where(F.lower(F.col(text)).rlike(rf"(^|[\s-])({any_token})([\s-]|$)"))
        .withColumn("_tokens", tokens(text))
        .withColumn("score", held.cast("bigint"))
        .withColumn("n_tokens", F.size("_tokens").cast("bigint"))
        .drop("_tokens")
    )


def search_items(
    items: DataFrame, keywords, key: str = "item", text: str = "description"
) -> DataFrame:
    """Best match first: most tokens held, then shortest text, then key."""
    found = keyword_matches(items, text, keywords)
    return found.orderBy(F.desc("score"), "n_tokens", key)
