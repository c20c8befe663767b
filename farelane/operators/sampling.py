"""Order and head samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.operators.quantiles import rank_cuts
from farelane.schema import null_safe_hash


def sort_trips(df: DataFrame) -> DataFrame:
    """By pickup time, trips without one last; ``key`` parts equal times, also for the
    range partitioning, so that a crowded instant still spreads."""
    return df.orderBy(F.col("pickup_datetime").asc_nulls_last(), "key")


def head_sample(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by ``key``."""
    return _head(df, lambda count: n)


def head_fraction(df: DataFrame, fraction: float) -> DataFrame:
    """The first ``int(count * fraction)`` rows by ``key``."""
    return _head(df, lambda count: int(count * fraction))


def _head(df: DataFrame, size: Callable[[int], int]) -> DataFrame:
    # The n-th key is found by counting; taking the rows is then a filter, not a sort.
    order = [F.col("key"), null_safe_hash(df.columns)]
    _, [cut] = rank_cuts(df, order, lambda count: [size(count)])
    if cut.take == cut.ties:
        return df.filter(cut.inside | cut.tied)
    # Only copies of one row are left level at the cut, so one of them stands for all.
    copy = df.filter(cut.tied).first()
    copies = df.sparkSession.range(cut.take).select(
        *[F.lit(copy[f.name]).cast(f.dataType).alias(f.name) for f in df.schema]
    )
    return df.filter(cut.inside).unionByName(copies)
