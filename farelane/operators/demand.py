"""Rolling demand: how many trips began in the time before each trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.operators.running import SLICE_ROWS, running_totals
from farelane.operators.stats import group_profile

HALF_HOUR = 30 * 60 * 1_000_000
HOUR = 2 * HALF_HOUR


def rolling_count(
    df: DataFrame, width_us: int, name: str, value: str = "fare_amount", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Per trip with a pickup time t: the non-null values with a pickup in (t - width, t],
    its own included. Of trips at the same instant each sees those up to its ``key``."""
    return rolling_counts(df, {name: width_us}, value, slice_rows)


def rolling_counts(
    df: DataFrame, widths: dict[str, int], value: str = "fare_amount", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """As ``rolling_count`` for several widths, in microseconds by the name of their column, at once.

    A sweep over arrivals and departures. Time is cut into buckets as wide as the widest window; a
    trip arrives in its own bucket (+1) and departs from each window one width later (-1), in its
    bucket or the next. At the start of a bucket a window holds the trips that arrived before the
    bucket and depart in it. One shuffle brings each bucket together for all widths, and the running
    sums are linear in its rows, unlike a sliding frame. All columns of ``df`` take part in it, so
    select those that are needed before.
    """
    us = F.unix_micros("pickup_datetime")
    counted = F.col(value).isNotNull()
    widest = max(widths.values())
    # A move is an arrival (width 0) or the departure from a window; a trip that isn't counted only arrives.
    apart = sorted(set(widths.values()))
    all_moves = F.array(*[F.lit(w) for w in [0, *apart]])
    moves = df.filter(F.col("pickup_datetime").isNotNull()).withColumn(
        "width_", F.explode(F.when(counted, all_moves).otherwise(F.array(F.lit(0))))
    )
    arrives = F.col("width_") == 0
    at = us + F.col("width_")
    bucket = lambda t: t - F.pmod(t, F.lit(widest))
    # A departure carries its time and order only.
    kept = {c: F.when(arrives, F.col(c)) for c in df.columns if c != "key"}
    moves = moves.withColumns(
        {
            "at_": at,
            "arrives_": F.when(arrives, 1).otherwise(0),
            "bucket_": bucket(at),
            "from_before_": (bucket(us) < bucket(at)).cast("int"),
            "counted_": counted.cast("int"),
            **kept,
        }
    )
    departs = {name: F.col("width_") == width for name, width in widths.items()}
    swept = running_totals(
        moves,
        ["bucket_"],
        ["at_", "arrives_", "key", "width_"],
        {name: F.when(arrives, F.col("counted_")).when(d, -1).otherwise(0) for name, d in departs.items()},
        {f"{name}_before_": F.when(d, F.col("from_before_")).otherwise(0) for name, d in departs.items()},
        slice_rows,
    )
    return swept.filter(F.col("arrives_") == 1).select(
        *df.columns, *[(F.col(f"{name}_before_") + F.col(name)).alias(name) for name in widths]
    )


def demand_fare_corr(df: DataFrame, count: str, value: str = "fare_amount") -> DataFrame:
    """One row: the correlation of the demand before a trip with its fare."""
    return df.agg(F.corr(count, value).alias("corr"))


def demand_fare_table(df: DataFrame, count: str, value: str = "fare_amount") -> DataFrame:
    """Per demand level: the number of fares, their mean and their median."""
    return group_profile(df, count, value).select(
        count, "n", F.col("mean").alias("mean_fare"), F.col("median").alias("median_fare")
    )
