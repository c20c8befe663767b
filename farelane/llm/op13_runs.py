"""Periodic runs of words: branching squares of an enhanced suffix array, rotated and merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.texts import slices

#: Periods that a run holds at least, and words.
PERIODS, WORDS = 4, 6
#: Bytes of text whose suffixes are sorted at once; one longer text is sorted alone.
HELD_BYTES = 2 << 20
#: Comparisons that a square is first rotated by; each further step doubles them.
FIRST_STEP = 8

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _runs_of_true(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of true begin and end (exclusive)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def stretches(rows: np.ndarray, index: np.ndarray, periods: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The words that can stand in a run, as one string: a number for each and its place in the slice.

    A word of a run occurs ``periods`` times in its document, and a run has ``words`` words. What
    can't be in one is left out; a number of its own parts the stretches, and ends the string.
    """
    key = rows.astype(np.int64) * (int(index.max()) + 1 if len(index) else 1) + index
    _, code, counts = np.unique(key, return_inverse=True, return_counts=True)
    code = code.reshape(-1)
    often = counts[code] >= periods
    # A document's end parts stretches as a word that is left out does.
    opens = np.concatenate([[False], rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, bool)
    place = np.arange(len(rows)) + np.cumsum(opens)
    spread = np.zeros(int(place[-1]) + 1 if len(place) else 0, dtype=bool)
    spread[place] = often
    begin, end = _runs_of_true(spread)
    long = end - begin >= words
    begin, end = begin[long], end[long]
    source = np.full(len(spread), -1, dtype=np.int64)
    source[place] = np.arange(len(rows))
    sizes = end - begin + 1
    at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    parted = np.cumsum(sizes) - 1
    at[parted] = 0
    word = source[at]
    word[parted] = -1
    text = np.where(word >= 0, code[word] if len(code) else 0, 0)
    text[parted] = len(counts) + np.arange(len(parted))
    return text, word


class SuffixArray:
    """Suffixes of ``text`` in order (``order``), the place of each (``place``), and the common
    beginning of each with the one before (``common``).

    Groups of suffixes with equal beginnings are sorted by the group of a later suffix, which doubles
    the beginning. A group of fewer than ``least`` is left as it is: no interval in it is of use, and
    its suffixes stand in the right place of every larger one. Numbers that occur once end a match.
    """

    def __init__(self, text: np.ndarray, least: int) -> None:
        n = len(text)
        self.order = np.argsort(text, kind="stable")
        group = self._starts(text[self.order])
        self.levels = [self._ranks(group, self.order, np.zeros(n, np.int64))]
        self.common = np.full(n + 1, n, dtype=np.int64)
        self.common[np.flatnonzero(np.diff(group)) + 1] = 0
        self.common[[0, n]] = 0
        slot = self._large(group, np.arange(n), least)
        have = 1
        while len(slot):
            rank = self.levels[-1]
            suffix = self.order[slot]
            key = rank[suffix] * np.int64(n) + rank[suffix + have]
            by = np.argsort(key, kind="stable")
            suffix, key = suffix[by], key[by]
            self.order[slot] = suffix
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.flatnonzero(fresh)
            group = np.repeat(slot[first], np.diff(np.append(first, len(slot))))
            # Neighbours that part in this round, not those that were in two groups before.
            part = first[1:]
            part = part[rank[suffix[part]] == rank[suffix[part - 1]]]
            a, b = suffix[part - 1] + have, suffix[part] + have
            self.common[slot[part]] = have + self._common(a, b)
            self.levels.append(self._ranks(group, suffix, rank))
            slot = self._large(group, slot, least)
            have *= 2
        self.place = np.empty(n, dtype=np.int64)
        self.place[self.order] = np.arange(n)

    @staticmethod
    def _starts(values: np.ndarray) -> np.ndarray:
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
        return np.repeat(first, np.diff(np.append(first, len(values))))

    @staticmethod
    def _ranks(group: np.ndarray, suffix: np.ndarray, before: np.ndarray) -> np.ndarray:
        rank = before.copy()
        rank[suffix] = group
        return rank

    @staticmethod
    def _large(group: np.ndarray, slot: np.ndarray, least: int) -> np.ndarray:
        """The slots of groups of ``least`` suffixes or more."""
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(group)))
        return slot[np.repeat(size >= least, size)]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that suffixes ``a`` and ``b``, which differ in the last level, have in common."""
        total = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            rank = self.levels[level]
            step = np.where(rank[a] == rank[b], 1 << level, 0)
            a, b, total = a + step, b + step, total + step
        return total

    def intervals(self, least: int) -> np.ndarray:
        """The intervals of ``least`` suffixes or more: depth, first, last, and their largest child's
        first and last."""
        found: list[tuple[int, ...]] = []
        stack: list[list[int]] = []  # depth, first, first and last of the largest child
        common = self.common.tolist()
        for k in range(1, len(common)):
            depth = common[k]
            first, child = k - 1, (k - 1, k - 1)
            while stack and stack[-1][0] > depth:
                top = stack.pop()
                if child[1] - child[0] > top[3] - top[2]:
                    top[2:] = child
                if k - top[1] >= least:
                    found.append((top[0], top[1], k - 1, top[2], top[3]))
                first, child = top[1], (top[1], k - 1)
            if depth == 0:
                continue
            if stack and stack[-1][0] == depth:
                if child[1] - child[0] > stack[-1][3] - stack[-1][2]:
                    stack[-1][2:] = child
            else:
                stack.append([depth, first, *child])
        return np.array(found, dtype=np.int64).reshape(-1, 5)


def branching_squares(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of each square that the word after it does not continue.

    Of an interval of depth d all suffixes but those of its largest child ask whether the suffix d
    words on, or d words before, is in the interval too, while the word after parts the two.
    """
    none = np.zeros(0, np.int64)
    if not len(text):
        return none, none
    array = SuffixArray(text, least)
    depth, first, last, child, child_last = array.intervals(least).T
    sizes = (last - first) - (child_last - child)
    which = np.repeat(np.arange(len(depth)), sizes)
    k = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    k += np.where(k >= child[which], child_last[which] - child[which] + 1, 0)
    suffix, d = array.order[k], depth[which]
    starts, periods = [none], [none]
    for near in (suffix + d, suffix - d):
        inside = (near >= 0) & (near < len(text))
        other = array.place[np.where(inside, near, 0)]
        inside &= (other >= first[which]) & (other <= last[which])
        start, period = np.minimum(suffix, near)[inside], d[inside]
        parts = text[start + period] != text[start + 2 * period]
        starts.append(start[parts])
        periods.append(period[parts])
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return both[0], both[1]


def rotated(text: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The first word that each square reaches by rotating to the left, a growing stretch at a time."""
    start = start.copy()
    going, step = np.arange(len(start)), FIRST_STEP
    while len(going):
        at = start[going, None] - 1 - np.arange(step)
        same = (at >= 0) & (text[np.maximum(at, 0)] == text[np.maximum(at, 0) + period[going, None]])
        moved = np.where(same.all(axis=1), step, np.argmin(same, axis=1))
        start[going] -= moved
        going, step = going[moved == step], step * 2
    return start


def merged_runs(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of each run that a branching square ends.

    Of the squares with one end the smallest is rotated first; the larger ones that lie in its run
    have a multiple of its period and are merged into it, which leaves few for the next round.
    """
    start, period = branching_squares(text, least)
    end = start + 2 * period
    by = np.lexsort((period, end))
    start, period, end = start[by], period[by], end[by]
    out = [(start[:0], end[:0], period[:0])]
    while len(start):
        first = np.concatenate([[True], end[1:] != end[:-1]])
        run = np.flatnonzero(first)
        begin = rotated(text, start[run], period[run])
        out.append((begin, end[run], period[run]))
        rest = ~first & (start < begin[np.cumsum(first) - 1])
        start, period, end = start[rest], period[rest], end[rest]
    return tuple(np.concatenate(x) for x in zip(*out))


def slice_runs(rows: np.ndarray, index: np.ndarray, periods: int, words: int) -> tuple[np.ndarray, ...]:
    """The runs of a slice of documents by their first word in the slice: it, their length and period."""
    text, word = stretches(rows, index, periods, words)
    start, end, period = merged_runs(text, periods)
    keep = end - start >= np.maximum(words, periods * period)
    start, end, period = start[keep], end[keep], period[keep]
    by = np.lexsort((period, start))
    return word[start[by]], (end - start)[by], period[by]


def find_runs(
    docs: DataFrame, periods: int = PERIODS, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` of each row of ``docs``.

    Words are parted by ASCII white space. A run is a stretch of words with a smallest period, at
    least ``periods`` (2 or more) of them and ``words`` words, that neither neighbour extends; ``runs``
    has each one's ``start`` (from 0), ``length`` and ``period`` in order of start, then period.
    ``collapsed`` is the text without what repeats: the words that no run holds after its first
    period, joined by a space.

    A document is worked on whole and alone, in the task that reads it; nothing is shuffled. Its time
    is that of sorting its suffixes. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Null ids and repeated rows are rows like others. An empty table gives no row. Other
    columns are not read.
    """
    if periods < 2 or words < 1:
        raise ValueError("a run has two periods and a word at least")

    def collapse(batches):
        for batch in slices(batches, limit=HELD_BYTES):
            parts = pc.ascii_split_whitespace(batch.column("text"))
            counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
            flat = parts.flatten()
            filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(parts)), counts)[filled]
            flat = flat.filter(pa.array(filled))
            index = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            first, length, period = slice_runs(rows, index, periods, words)
            ends = np.searchsorted(rows, np.arange(len(parts) + 1))
            row = rows[first]
            # A run's words after its first period go: +1 where they begin, -1 after their end.
            change = np.bincount(first + period, minlength=len(rows) + 1) - np.bincount(first + length, minlength=len(rows) + 1)
            kept = np.cumsum(change[: len(rows)]) == 0
            left = np.concatenate([[0], np.cumsum(kept)])[ends]
            lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept)))
            runs = pa.StructArray.from_arrays(
                [pa.array(first - ends[row], pa.int64()), pa.array(length, pa.int64()), pa.array(period, pa.int64())],
                ["start", "length", "period"],
            )
            cuts = pa.array(np.searchsorted(row, np.arange(len(parts) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.ListArray.from_arrays(cuts, runs),
                    pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    ids = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(collapse, f"doc_id {ids}, n_words long, runs {RUNS}, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """``doc_id``, ``n_runs``, the run with most periods (of equal ones the first, then that of the
    smaller period) with ``exponent_milli``, and hashes of all runs and of the collapsed text."""
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{k}").alias(k) for k in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
