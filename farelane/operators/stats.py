"""Counts, grouped medians, histograms and error metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.operators.running import running_total
from farelane.session import save_table


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def group_profile(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per non-null ``key``: how many values there are, their mean and their exact median.

    Rows are first counted per key and value, which combines on the map side and spreads a
    hot key over all tasks; the median is read off the running counts of those pairs.
    """
    pairs = save_table(
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key), F.col(value).cast("double").alias("value"))
        .agg(F.count(F.col(value)).alias("cnt")),
        "pairs",
    )
    ranked = running_total(pairs, [key], ["value"], F.col("cnt"), F.col("cnt"))
    middle = [F.floor((F.col("total") - 1) / 2), F.ceil((F.col("total") - 1) / 2)]
    holds = [(F.col("running") - F.col("cnt") <= m) & (m < F.col("running")) for m in middle]
    low, high = (F.max(F.when(h, F.col("value"))) for h in holds)
    return ranked.groupBy(key).agg(
        F.sum("cnt").alias("n"),
        (F.sum(F.col("value") * F.col("cnt")) / F.nullif(F.sum("cnt"), F.lit(0))).alias("mean"),
        ((low + high) / 2).alias("median"),
    )


def median_by(df: DataFrame, key: str, value: str = "fare_amount") -> DataFrame:
    """The exact median of ``value`` per non-null ``key``, in key order."""
    profile = group_profile(df, key, value)
    return profile.select(key, F.col("median").alias(f"median_{value}")).orderBy(key)


def size_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-null ``key``, in key order."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key)
    return counts.agg(F.count(F.lit(1)).alias("n_trips")).orderBy(key)


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the range of ``column``, the last one closed; empty ones count 0."""
    spark = df.sparkSession
    present = df.select(column).filter(F.col(column).isNotNull())
    lo, hi = present.agg(F.min(column), F.max(column)).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    # Rounding can put a value beside its bin, so it is held against the edges themselves.
    ends = F.array(*[F.lit(lo + i * width) for i in range(bins)], F.lit(float(hi)))
    near = F.greatest(F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)), F.lit(0)).cast("int")
    slot = (
        F.when(F.col(column) < F.get(ends, near), near - 1)
        .when((near < bins - 1) & (F.col(column) >= F.get(ends, near + 1)), near + 1)
        .otherwise(near)
    )
    counts = present.groupBy(slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    index = F.col("id").cast("int")
    edges = spark.range(bins).select(
        index.alias("bin"),
        (F.lit(lo) + index * F.lit(width)).alias("bin_start"),
        F.when(index == bins - 1, F.lit(float(hi)))
        .otherwise(F.lit(lo) + (index + 1) * F.lit(width))
        .alias("bin_end"),
    )
    # Both sides hold one row per bin.
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("n_trips")
    )


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: root of the mean squared error."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def r2(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: the share of the label's variance that the prediction explains."""
    y, p = F.col(label), F.col(prediction)
    both: Column = y.isNotNull() & p.isNotNull()
    unexplained = F.avg((y - p) * (y - p))
    return df.filter(both).agg((1 - unexplained / F.var_pop(y)).alias("r2"))
