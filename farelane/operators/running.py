"""Running totals within groups, safe from groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from farelane.session import save_table

#: Rows of a slice, whatever the number of rows or the size of a group.
SLICE_ROWS = 1_000_000


def running_total(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: Column,
    overall: Column,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``running``, the sum of ``value`` over the group's rows up to and including the
    current one, and ``total``, the sum of ``overall`` over the whole group, as ``running_totals``."""
    return running_totals(df, group, order, {"running": value}, {"total": overall}, slice_rows)


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[str],
    values: dict[str, Column],
    overall: dict[str, Column],
    slice_rows: int,
) -> DataFrame:
    """Add for each of ``values`` the sum over the group's rows up to and including the current one,
    and for each of ``overall`` the sum over the whole group, all in one pass over the slices.

    ``order`` has to be total within a group. The rows are cut into ranges of (group, order) of
    about ``slice_rows`` rows each, so a hot group, even one crowded instant, takes many slices
    and a slice many small groups. Each is summed, and starts at the sum of its group's earlier ones.
    """
    summands = {f"{k}_value_": c for k, c in (values | overall).items()}
    seen = Observation()
    df = save_table(df.withColumns(summands).observe(seen, F.count(F.lit(1)).alias("n")), "summands")
    slices = max(1, -(-seen.get["n"] // slice_rows))
    ranged = df.repartitionByRange(slices, *group, *order)
    # Saved, because the slice a row falls in must be the same in both uses below.
    saved = save_table(ranged.withColumn("slice_", F.spark_partition_id()), "slices")
    # At most one row per slice and group boundary.
    sums = saved.groupBy(*group, "slice_").agg(*[F.sum(c).alias(c) for c in summands])
    in_group = Window.partitionBy(*group)
    before = in_group.orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(g).alias(f"{g}_of") for g in group],
        F.col("slice_").alias("slice_of"),
        *[F.coalesce(F.sum(f"{k}_value_").over(before), F.lit(0)).alias(f"{k}_start_") for k in values],
        *[F.sum(f"{k}_value_").over(in_group).alias(k) for k in overall],
    )
    so_far = (
        Window.partitionBy(*group, "slice_")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.col("slice_") == F.col("slice_of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_of"))
    return (
        saved.withColumns({k: F.sum(f"{k}_value_").over(so_far) for k in values})
        .join(starts, same)
        .withColumns({k: F.col(k) + F.col(f"{k}_start_") for k in values})
        .drop("slice_", "slice_of", *summands, *[f"{k}_start_" for k in values], *[f"{g}_of" for g in group])
    )
