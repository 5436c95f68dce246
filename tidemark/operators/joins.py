"""Key joins whose large side may hold one very hot key.

AQE splits a hot partition only where both join inputs are plain shuffles. A
de-duplicated or aggregated key side is already partitioned by the key and would
be joined in place, which switches the split off. The hash of the key, added as a
second join key, makes the planner shuffle both inputs afresh, so the split stays
possible. Small key sides are still broadcast, by the planner's own size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_HASH = "_key_hash"


def _names(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def with_key_hash(df: DataFrame, on) -> DataFrame:
    return df.withColumn(KEY_HASH, F.xxhash64(*_names(on)))


def member_rows(
    rows: DataFrame,
    keys: DataFrame,
    on,
    unique: bool = False,
    one_row_per_key: bool = False,
    negate: bool = False,
) -> DataFrame:
    """`rows` whose key is (or with `negate` is not) in `keys`.

    `unique` states that `keys` is a stored table with one row per key, so it needs
    neither the de-duplication nor the second key. `one_row_per_key` states that
    `rows` has one row per key: nothing can be hot, and the join reuses the
    partitioning of the de-duplicated keys.
    """
    names = _names(on)
    how = "left_anti" if negate else "left_semi"
    keys = keys.select(*names)
    if unique:
        return rows.join(keys, names, how)
    if one_row_per_key:
        return rows.join(keys.distinct(), names, how)
    keys = with_key_hash(keys.distinct(), names)
    return with_key_hash(rows, names).join(keys, names + [KEY_HASH], how).drop(KEY_HASH)


def lookup(
    rows: DataFrame, table: DataFrame, on, how: str = "left", stored: bool = True
) -> DataFrame:
    """Attach the columns of a one-row-per-key `table`; `stored=False` marks a
    table that comes out of an aggregation by the key."""
    names = _names(on)
    if stored:
        return rows.join(table, names, how)
    return (
        with_key_hash(rows, names)
        .join(with_key_hash(table, names), names + [KEY_HASH], how)
        .drop(KEY_HASH)
    )
