"""What the near duplicates ask of the driver: few jobs, and sketches as classes."""

from __future__ import annotations

import random
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa

from farelane.llm.components import components
from farelane.llm.op07_jaccard_join import FINE, _cells, count_sketch, one_of_each, shingle_sets


def _jobs(spark, run):
    """What ``run`` returns, and how many Spark jobs it took."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    try:
        return run(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_few_jobs_where_all_links_are_found_at_pivots(spark, make):
    rng = random.Random(5)
    words, rows = [f"w{i}" for i in range(400)], [(1000, None), (1001, ""), (1002, "a b"), (1003, "A b")]
    for i in range(60):
        text = rng.sample(words, 60)
        rows.append((2 * i, " ".join(text)))
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join(text[:-1] + ["other"])))
    kept, jobs = _jobs(spark, lambda: sorted(r.doc_id for r in one_of_each(make(*rows)).collect()))
    assert kept == [2 * i for i in range(60)] + [1000, 1001, 1002]
    assert jobs <= 100


def test_a_round_of_components_is_counted_as_it_is_written(spark):
    found, jobs = _jobs(spark, lambda: components(spark.createDataFrame([], "u long, v long")).collect())
    assert found == [] and jobs <= 9


def test_sketches_are_classes_of_counts(spark, make):
    texts = ["one two three four", "one two three", "two three four five two three four", None, ""]
    shingles, words = count_sketch(make(*enumerate(texts)).repartition(3), 3)
    expected = Counter(c for own, _ in shingle_sets(pa.array([t or "" for t in texts]), 3) for c in _cells(own).tolist())
    at = np.flatnonzero(shingles)
    assert shingles.dtype == np.uint8 and at.tolist() == sorted(expected)
    assert shingles[at].tolist() == [int(FINE * np.log2(expected[c] + 1)) for c in at.tolist()]
    once, twice, thrice, often = (int(FINE * np.log2(n + 1)) for n in (1, 2, 3, 4))
    assert sorted(words[words > 0].tolist()) == [once, twice, thrice, often, often]
