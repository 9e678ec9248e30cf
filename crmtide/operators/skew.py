"""Finding the join keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000


def key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(df: DataFrame, columns: Sequence[str], min_rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with ``min_rows`` rows or more, all of them.

    There can be no more of them than rows / ``min_rows``. Counts are combined
    before their shuffle. A key with a NULL part matches nothing, so it is never
    hot. Use the result only to choose how rows are joined, never which rows are.
    """
    counts = df.dropna(subset=list(columns)).groupBy(key_hash(columns).alias("h")).count()
    return [r["h"] for r in counts.filter(F.col("count") >= min_rows).collect()]


def is_hot(columns: Sequence[str], hot: Sequence[int]) -> Column:
    return key_hash(columns).isin(list(hot))
