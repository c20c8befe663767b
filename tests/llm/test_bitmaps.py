"""The bitmaps of shingle sets against the sets themselves."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm.op07_jaccard_join import LEAST_WORDS, _near, differing, differing_short, parity_bits, shortened


def _pairs(seed: int):
    rng = np.random.default_rng(seed)
    for n in (1, 2, 5, 31, 32, 33, 64, 65, 200, 900):
        for share in (0.3, 0.7, 0.8, 0.85, 0.9, 0.97, 1.0):
            whole = np.unique(rng.integers(0, 1 << 63, 3 * n + 3, dtype=np.uint64))
            rng.shuffle(whole)
            same = int(n * share)
            other = max(1, int(n * rng.choice([0.6, 0.8, 1.0, 1.2])))
            a, b = whole[:n], np.concatenate([whole[:same], whole[n : n + max(other - same, 0)]])
            yield np.sort(a), np.sort(b if len(b) else whole[-1:])


@pytest.mark.parametrize("percent", [80, 90])
def test_bitmaps_never_part_linked_sets(spark, percent):
    rows, expected = [], []
    for i, (a, b) in enumerate(_pairs(percent)):
        common, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        rows.append((i, (len(a), parity_bits(a).tolist()), (len(b), parity_bits(b).tolist())))
        expected.append((common, either))
    kind = "struct<n: long, bits: array<long>>"
    pairs = spark.createDataFrame(rows, f"i int, x {kind}, y {kind}")
    for k in ("x", "y"):
        pairs = pairs.withColumn(k, F.struct(f"{k}.*", shortened(f"{k}.bits").alias("short")))
    whole, short = differing("x", "y"), differing_short("x", "y")
    got = pairs.select("i", whole, short, _near(whole, "x", "y", percent)).orderBy("i").collect()
    parted = 0
    for (_, cells, fewer, near), (common, either) in zip(got, expected):
        assert fewer <= cells <= either - common and (either - common - cells) % 2 == 0
        if 100 * common >= percent * either:
            assert near
        parted += not near
    # Most of those well below the limit are told apart without their sets.
    assert parted >= 0.8 * sum(100 * c < (percent - 10) * e for c, e in expected)


def test_bitmap_cells():
    assert parity_bits(np.zeros(0, np.uint64)).tolist() == [0] * LEAST_WORDS
    assert parity_bits(np.array([3, 3 + 64 * LEAST_WORDS], np.uint64)).tolist() == [0] * LEAST_WORDS
    assert parity_bits(np.array([64], np.uint64)).tolist() == [0, 1] + [0] * (LEAST_WORDS - 2)
    assert len(parity_bits(np.arange(1000, dtype=np.uint64))) == 32
