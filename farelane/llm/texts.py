"""Arrow helpers that the Python-backed operators share: slicing batches and splitting texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 8 << 20
#: Rows that a Python worker is sent at once where long texts make larger batches heavy.
BATCH_ROWS = 1000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes of text; null text is empty."""
    # Arrow's own pool keeps what it has freed, beside what the C library keeps; a worker has one of them.
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        place = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(place)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            part = batch.slice(lo, hi - lo)
            # A copy, since Arrow's lower-casing takes the buffer of a cut array from its beginning.
            text = part.column(at).cast(pa.large_string()).take(pa.array(np.arange(hi - lo)))
            text = pc.fill_null(text, "")
            yield part.set_column(at, column, text)
    give_back()


def gathered(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Small batches put together to about ``limit`` bytes of text, so that they can be sent small and
    worked on as one slice."""
    held, size = [], 0

    def together() -> list[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).combine_chunks()
        # The small ones are let go before the slice is worked on.
        held.clear()
        return whole.to_batches()

    for batch in batches:
        if held and size + batch.column(column).nbytes > limit:
            yield from together()
            size = 0
        held.append(batch)
        size += batch.column(column).nbytes
    if held:
        yield from together()


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Fewer rows at once for Python workers while the jobs inside run; the setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(given)) if int(given) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, given)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on and shares its executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def words_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row of each word, its index among the distinct words, and those; ASCII white space parts."""
    parts = pc.ascii_split_whitespace(text)
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(parts)), counts)
    coded = parts.flatten().dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    filled = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
    keep = filled[index]
    return rows[keep], index[keep], coded.dictionary


def hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text; the same in every process."""
    if len(values) == 0:
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(np.array(values.to_pylist(), dtype=object), categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _STEP
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


def joined(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several, in order."""
    out = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for part in parts:
        out = mix(out * _MIX + part)
    return out
