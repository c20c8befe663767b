"""Keys of rows by content, and broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["key_a", "key_b"]

#: Rows of a few columns that may be broadcast.
BROADCAST_ROWS = 200_000


def row_key(*columns: Column) -> list[Column]:
    """128 bits of the columns' values as two numbers; null differs from every value.

    Rows that agree in all of the columns share a key, so what is found by key holds for each of them.
    """
    parts = [x for c in columns for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(KEY)]


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a hint to broadcast it if it has at most ``rows`` rows; it should be a saved table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: One of so many rows may share a key without being frequent; there are fewer frequent keys than that.
FREQUENT = 1000


def join_frequent(left: DataFrame, right: DataFrame, key: str, count: str) -> DataFrame:
    """The inner join of ``left`` with ``right``, a saved table that has a row for each of its keys and
    how many rows of ``left`` have it.

    Keys that more than one of ``FREQUENT`` rows share are broadcast, since there are fewer than that;
    the rows of other keys are few for each and meet by a shuffle, or a broadcast if that is small.
    """
    most = (right.agg(F.sum(count)).first()[0] or 0) // FREQUENT
    hot = F.broadcast(right.filter(F.col(count) > most))
    found = left.join(hot, key)
    rest = right.filter(F.col(count) <= most)
    if not most or not rest.limit(1).count():
        return found
    cold = left.join(F.broadcast(right.filter(F.col(count) > most).select(key)), key, "left_anti")
    return found.unionByName(cold.join(broadcast_if_small(rest), key))
