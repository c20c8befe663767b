"""Exact order statistics without a sort.

A quantile sketch brackets the wanted ranks. Where a bracket has few rows, one counting pass lists
them by value; where it has many, that pass writes them to a table of (value, count), and whatever
is left to narrow is narrowed there: the source is read twice, whatever its size. A pass is a
map-side-combined aggregate over one column: nothing is sorted or gathered.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.session import save_table

# Quantiles that are read from a sketch, and its parameter; its error in rank is some 3 / parameter.
GRID = 500
SKETCH_ACCURACY = 1024
# The sketches of all tasks meet in so many groups first, and these in one.
MEETING = 64
CELLS = 4096
FEW = 2 * CELLS


@dataclass(frozen=True)
class Cell:
    """Consecutive values: their bounds, how many there are and how many are smaller."""

    lo: float | int
    hi: float | int
    below: int
    n: int

    def value_at(self, rank: int) -> float | int:
        return self.lo if rank == self.below else self.hi


@dataclass(frozen=True)
class Sketch:
    """The number of values and ``GRID`` + 1 quantiles of them, roughly."""

    count: int
    cuts: list

    def bracket(self, rank: int) -> tuple:
        """Where the value of a rank is expected, and how many rows are there."""
        at = rank / max(self.count - 1, 1) * GRID
        margin = 1 + math.ceil(GRID * 3 / max(SKETCH_ACCURACY, 8))
        first, last = max(math.floor(at) - margin, 0), min(math.ceil(at) + margin, GRID)
        return self.cuts[first], self.cuts[last], self.count * (last - first) / GRID


def _sketched(value: Column, integral: bool) -> Column:
    build = F.kll_sketch_agg_bigint if integral else F.kll_sketch_agg_double
    return build(value, F.lit(max(SKETCH_ACCURACY, 8)))


def merged_sketch(sketches: DataFrame, integral: bool) -> Sketch:
    """Of a table of sketches (``sketch``) and what they count (``n``) the sketch of all together."""
    merge = F.kll_merge_agg_bigint if integral else F.kll_merge_agg_double
    read = F.kll_sketch_get_quantile_bigint if integral else F.kll_sketch_get_quantile_double
    ranks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    whole = sketches.filter(F.col("n") > 0).agg(F.sum("n").alias("n"), merge("sketch").alias("sketch"))
    count, cuts = whole.select("n", F.when(F.col("n") > 0, read("sketch", ranks))).first()
    return Sketch(count or 0, cuts or [])


def _sketch(values: DataFrame, integral: bool) -> Sketch:
    groups = values.groupBy((F.spark_partition_id() % MEETING).alias("meet"))
    return merged_sketch(groups.agg(F.count("v").alias("n"), _sketched(F.col("v"), integral).alias("sketch")), integral)


def order_stats(
    df: DataFrame,
    column: Column | str,
    ranks_of: Callable[[int], Iterable[int]],
    with_ties: bool = True,
    span: tuple[int, int] | None = None,
    sketch: Sketch | None = None,
) -> tuple[int, dict[int, Cell]]:
    """The non-null count of a numeric column and, for the 0-based ranks that ``ranks_of``
    names for that count, the cell holding just the values equal to the one at the rank.

    Without ``with_ties`` a cell that begins or ends at the rank will do, since its bound is
    the value. ``span`` is where the values are expected, evenly spread; it saves the sketch, as
    does a ``sketch`` of the column, and neither affects the result. NaN counts as null.
    """
    source = F.col(column) if isinstance(column, str) else column
    kind = df.select(source.alias("v")).schema["v"].dataType
    integral = isinstance(kind, T.IntegralType)
    # Nulls need no filter, which would evaluate a derived column once more: counts, bounds
    # and the sketch skip them.
    present = source.cast("long") if integral else F.nanvl(source.cast("double"), F.lit(None))
    values = df.select(present.alias("v"))

    if span is None and sketch is None and isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        # Small codes and counts, most likely: one pass with a cell per value may do.
        span = (-CELLS // 2, CELLS // 2 - 1)
    if span is not None:
        count, spans = 0, [(*span, math.inf)]
    else:
        sketch = sketch or _sketch(values, integral)
        count = sketch.count
        spans = _merge(sketch.bracket(r) for r in ranks_of(count) if 0 <= r < count)

    found: dict[int, Cell] = {}
    # Values by their count: at first each row for itself, then what a bracket holds.
    whole = values.select(F.col("v").alias("lo"), F.col("v").alias("hi"), F.when(F.col("v").isNotNull(), 1).alias("n"))
    table, listed = whole, None
    while spans:
        rows = sum(n for *_, n in spans)
        if listed is None and FEW < rows < math.inf:
            table, listed = save_table(_cells(whole, spans, integral, all_listed=True), "bracket"), spans
        counted = _cells(table, spans, integral).filter(F.col("n") > 0).collect()
        cells = sorted(counted, key=lambda row: (row["cell"], row["lo"]))
        ends = list(accumulate(row["n"] for row in cells))
        count = ends[-1] if ends else 0
        open_spans = []
        for rank in {r for r in ranks_of(count) if 0 <= r < count} - found.keys():
            at = bisect.bisect_right(ends, rank)
            row = cells[at]
            cell = Cell(row["lo"], row["hi"], ends[at] - row["n"], row["n"])
            at_bound = rank in (cell.below, ends[at] - 1)
            if cell.lo == cell.hi or (at_bound and not with_ties):
                found[rank] = cell
            else:
                open_spans.append((cell.lo, cell.hi, cell.n))
        spans = _merge(open_spans)
        if listed and not all(any(a <= lo and hi <= b for a, b, _ in listed) for lo, hi, _ in spans):
            # The sketch was wrong about a rank, which is outside of what was written.
            table, listed = whole, None
    return count, found


def _merge(spans: Iterable[tuple]) -> list[tuple]:
    """Spans with overlapping ones joined; the number of rows in a joined span adds up."""
    merged: list[tuple] = []
    for lo, hi, n in sorted(set(spans)):
        if merged and lo <= merged[-1][1]:
            before = merged[-1]
            merged[-1] = (before[0], max(hi, before[1]), before[2] + n)
        else:
            merged.append((lo, hi, n))
    return merged


def _cells(table: DataFrame, spans: list[tuple], integral: bool, all_listed: bool = False) -> DataFrame:
    """Counts (``n``) and exact bounds of consecutive cells of a table of values or runs of them
    (``lo``, ``hi``, ``n``): one per value in a span of few rows, or in every span if ``all_listed``,
    ``CELLS`` in any other, and one per gap.

    A cell number never falls as the value rises, which is all the ranks need; how evenly
    the cells are cut only decides how soon a span shrinks.
    """
    v = F.col("lo")
    cell = listed = None
    for i, (lo, hi, n) in enumerate(spans):
        base = i * (CELLS + 1)
        low, high = (F.lit(x).cast("long" if integral else "double") for x in (lo, hi))
        single = lo == hi or n <= FEW or all_listed
        at = F.lit(0) if single else _position(v, lo, hi, integral)
        cell = F.when(v < low, base) if cell is None else cell.when(v < low, base)
        cell = cell.when(v <= high, at + (base + 1))
        if single:
            inside = v.between(low, high)
            listed = F.when(inside, v) if listed is None else listed.when(inside, v)
    cell = cell.otherwise(len(spans) * (CELLS + 1))
    keys = [cell.alias("cell")] + ([] if listed is None else [listed.alias("listed")])
    return table.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _position(v: Column, lo, hi, integral: bool) -> Column:
    # Differences stay exact in long, or finite in double, wherever the span allows either.
    if integral and hi - lo < 2**63:
        share = (v - F.lit(lo).cast("long")) / F.lit(float(hi - lo))
    else:
        half = 1.0 if math.isfinite(float(hi) - float(lo)) else 0.5
        low, high = (max(min(float(x), 1.7e308), -1.7e308) * half for x in (lo, hi))
        share = (v.cast("double") * half - low) / (high - low)
    cell = F.floor(share * CELLS)
    return F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), cell.cast("int")))


def _ranks_around(q: float) -> Callable[[int], list[int]]:
    return lambda count: [math.floor((count - 1) * q), math.ceil((count - 1) * q)]


def _interpolated(q: float, count: int, value_at: Callable[[int], float | int]) -> float | None:
    if count == 0:
        return None
    at = (count - 1) * q
    low, high = (float(value_at(r)) for r in _ranks_around(q)(count))
    return low + (high - low) * (at - math.floor(at)) if high != low else low


def exact_quantile(df: DataFrame, column: Column | str, q: float, sketch: Sketch | None = None) -> float | None:
    """The linearly interpolated quantile of the non-null values; None when there are none."""
    count, cells = order_stats(df, column, _ranks_around(q), with_ties=False, sketch=sketch)
    return _interpolated(q, count, lambda rank: cells[rank].value_at(rank))


def chained_quantiles(
    df: DataFrame, first: str, first_q: float, second: Column, second_q: float
) -> tuple[float | None, float | None]:
    """The ``first_q`` quantile of column ``first``, a small whole number, and the ``second_q`` quantile
    of ``second`` over the rows whose ``first`` is null or not above that quantile.

    ``df`` is read twice. One pass counts the rows of each value of ``first`` and keeps a sketch of
    ``second`` for each; the first quantile is read off the counts, and the sketches of the values
    that it leaves, merged, bracket the second for the other pass. What is beyond ``CELLS`` values
    around 0 is two values more; should the quantile fall there, it is looked for as any other.
    """
    second = F.nanvl(second.cast("double"), F.lit(None))
    half = CELLS // 2
    held = F.greatest(F.least(F.col(first).cast("long"), F.lit(half)), F.lit(-half))
    keyed = df.select(held.alias("k"), second.alias("v"))
    parts = keyed.groupBy("k", (F.spark_partition_id() % MEETING).alias("meet")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"), _sketched(F.col("v"), False).alias("sketch")
    )
    sketches = save_table(parts, "sketches")
    per_value = sketches.filter("k is not null").groupBy("k").agg(F.sum("rows").alias("rows")).collect()
    rows = sorted((r["k"], r["rows"]) for r in per_value)
    ends = list(accumulate(n for _, n in rows))
    count = ends[-1] if ends else 0
    around = [rows[bisect.bisect_right(ends, r)][0] for r in _ranks_around(first_q)(count)] if count else []
    if any(abs(k) >= half for k in around):
        limit = exact_quantile(df, first, first_q)
    else:
        limit = _interpolated(first_q, count, lambda rank: rows[bisect.bisect_right(ends, rank)][0])
    left, kept = df, sketches
    if limit is not None:
        left = df.filter(F.col(first).isNull() | (F.col(first) <= limit))
        kept = sketches.filter(F.col("k").isNull() | (F.col("k") <= limit))
    return limit, exact_quantile(left, second, second_q, merged_sketch(kept, False))


@dataclass(frozen=True)
class RankCut:
    """Where the first n rows of an order end: ``inside`` holds for rows before the cut,
    ``tied`` for the rows level with it, of which ``take`` of ``ties`` belong to the n."""

    inside: Column
    tied: Column
    take: int
    ties: int


def rank_cuts(
    df: DataFrame,
    order: list[Column],
    sizes: Callable[[int], list[int]],
    span: tuple[int, int] | None = None,
) -> tuple[int, list[RankCut]]:
    """The row count and, for each n in ``sizes(count)``, the cut after n rows in the order
    of the given non-null numeric columns. Later columns are read only to part rows that are
    level in the earlier ones at a cut. ``span`` is that of the first column, as in
    ``order_stats``."""
    count, cells = order_stats(df, order[0], lambda n: [s - 1 for s in sizes(n)], span=span)
    cuts = []
    for size in sizes(count):
        if size <= 0 or size >= count:
            cuts.append(RankCut(F.lit(size > 0), F.lit(False), 0, 0))
            continue
        cell = cells[size - 1]
        inside, tied = order[0] < F.lit(cell.lo), order[0] == F.lit(cell.lo)
        take, ties = size - cell.below, cell.n
        if take < ties and len(order) > 1:
            _, [finer] = rank_cuts(df.filter(tied), order[1:], lambda n, take=take: [take])
            inside, tied = inside | (tied & finer.inside), tied & finer.tied
            take, ties = finer.take, finer.ties
        cuts.append(RankCut(inside, tied, take, ties))
    return count, cuts
