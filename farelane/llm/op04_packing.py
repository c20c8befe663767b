"""Packing by minimum bin slack: each bin takes the fullest combination of the lengths left."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.texts import slices
from farelane.llm.tokens import Pieces
from farelane.session import save_table

PIECES = "block int, place long, doc_id {}, piece int, start long, length int, ids_crc32 long"
PACKED = "doc_id {}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length make the largest sum up to ``room``; long ones are tried first.

    Subset sums as bits of one number: bit s is set if some of the items so far sum to s. Equal
    lengths go in groups of 1, 2, 4, ... items, so a length costs a few shifts.
    """
    mask, bits, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        size = 1
        while left:
            take = min(size, left)
            steps.append((length, take, bits))
            bits |= (bits << (length * take)) & mask
            left, size = left - take, size * 2
        if bits >> room & 1:
            break
    total, chosen = bits.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def minimum_slack(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, items in each)]): every bin holds the longest length left and what fills it best.

    A combination is used for as many bins as the lengths allow, so the work grows with the number
    of different lengths, at most ``capacity``, and not with the number of items.
    """
    counts, plan = {k: v for k, v in histogram.items() if v}, []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = fullest({k: v for k, v in counts.items() if v and k <= capacity - longest}, capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        bins = min(counts[k] // n for k, n in chosen.items())
        plan.append((bins, sorted(chosen.items(), reverse=True)))
        for k, n in chosen.items():
            counts[k] -= bins * n
            if not counts[k]:
                del counts[k]
    return plan


def _runs(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length the runs of its items: first item, first bin, items in each bin, offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first_bin = 0
    for bins, combination in plan:
        offset = 0
        for length, n in combination:
            runs.setdefault(length, []).append((used.get(length, 0), first_bin, n, offset))
            used[length] = used.get(length, 0) + bins * n
            offset += n * length
        first_bin += bins
    return {k: np.array(v, dtype=np.int64) for k, v in runs.items()}


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int) -> DataFrame:
    """The pieces of each document with their place among those of one length in their task."""

    def pieces_of(batch: pa.RecordBatch, block: int, seen: np.ndarray) -> pa.RecordBatch:
        ids, starts = Pieces(batch.column("text"), tokenizer).ids(end)
        n = np.diff(starts)
        pieces = -(-n // capacity)
        row = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * capacity
        length = np.minimum(capacity, n[row] - start)
        ids, at = ids.astype("<u4", copy=False), starts[row] + start
        crc = [zlib.crc32(ids[a : a + k]) for a, k in zip(at.tolist(), length.tolist())]
        # The place of each piece among equal lengths: its rank here and those seen before.
        order = np.argsort(length, kind="stable")
        ordered = length[order]
        rank = np.empty(len(row), dtype=np.int64)
        rank[order] = np.arange(len(row)) - np.searchsorted(ordered, ordered)
        place = seen[length] + rank
        seen += np.bincount(length, minlength=capacity + 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(row), block, dtype=np.int32)),
                pa.array(place),
                batch.column("doc_id").take(pa.array(row)),
                pa.array(piece.astype(np.int32)),
                pa.array(start),
                pa.array(length.astype(np.int32)),
                pa.array(crc, pa.int64()),
            ],
            ["block", "place", "doc_id", "piece", "start", "length", "ids_crc32"],
        )

    def cut(batches):
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        # Nothing of a slice is left when the next one is taken.
        for batch in slices(batches):
            yield pieces_of(batch, block, seen)

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, PIECES.format(ids))


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece: its document, place there, checksum, sequence and place in that.

    A document is its ids and then ``end``; only one longer than ``capacity`` is cut. The pieces are
    written to the shared folder without their ids. Their numbers by length, at most ``capacity``
    rows whatever the data, are packed by minimum bin slack in the driver; the plan is a list of
    runs of equal items, and each piece finds its run by its rank among those of its length. Ranks
    are counts of the tasks before plus the place in the task, so a length of which there are
    many is not brought together.

    Null and empty texts are the end id alone. Repeated rows and null ids are packed each for
    itself; an empty table gives no row. Other columns are not read.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    pieces = save_table(cut_pieces(docs, tokenizer, capacity, end), "pieces")
    sizes = pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = save_table(
        sizes.select("block", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")),
        "starts",
    )
    histogram = {r.length: r.n for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = docs.sparkSession.sparkContext.broadcast(_runs(minimum_slack(histogram, capacity)))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            bins, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for k in np.unique(length):
                here = np.flatnonzero(length == k)
                own = runs.value[int(k)]
                first, first_bin, n, base = own[np.searchsorted(own[:, 0], rank[here], "right") - 1].T
                later = rank[here] - first
                bins[here], offset[here] = first_bin + later // n, base + later % n * k
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in ("doc_id", "piece", "start")),
                    pa.array(length.astype(np.int64)),
                    batch.column("ids_crc32"),
                    pa.array(bins),
                    pa.array(offset),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(starts.drop("n"), ["block", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    ids = docs.schema["doc_id"].dataType.simpleString()
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, PACKED.format(ids)
    )
